"""Token counts by a linear longest-match automaton.

A trie of the vocabulary gets, for each node, a failure link to the node of
what is left after greedy longest matches are taken off its string, and the
number of pieces taken off. A word's greedy piece count is then found in one
pass over its characters, without building pieces.

Words are runs of characters other than the six ASCII blanks; a word's first
piece begins with the vocabulary's word mark. A word that the vocabulary
cannot spell counts as one unknown token. Null and empty texts count zero; very
long texts and words are counted whole; repeated rows are counted each; an empty
table gives no rows. Columns other than id and text are not kept, so their names
clash with none of the result's.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import encoded, ship_by_value, slices

ship_by_value(__name__)

WORD_MARK = "▁"
UNKNOWN = 1 << 40
CACHE_WORDS = 300_000


class LongestMatch:
    """The automaton; ``count(word)`` is the number of greedy pieces, or None."""

    def __init__(self, pieces: Iterable[str]) -> None:
        self.step: list[dict[str, int]] = [{}]
        is_piece = [False]
        for piece in pieces:
            node = 0
            for ch in piece:
                nxt = self.step[node].get(ch)
                if nxt is None:
                    nxt = self.step[node][ch] = len(self.step)
                    self.step.append({})
                    is_piece.append(False)
                node = nxt
            if node:
                is_piece[node] = True
        self.fail = [-1] * len(self.step)
        self.popped = [0] * len(self.step)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for ch, node in self.step[parent].items():
                queue.append(node)
                if is_piece[node]:
                    self.fail[node], self.popped[node] = 0, 1
                    continue
                at, taken = self.fail[parent], self.popped[parent]
                while at >= 0 and ch not in self.step[at]:
                    taken += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.step[at][ch], taken

    def count(self, word: str) -> int | None:
        step, fail, popped = self.step, self.fail, self.popped
        node = total = 0
        for ch in word:
            while ch not in step[node]:
                if fail[node] < 0:
                    return None
                total += popped[node]
                node = fail[node]
            node = step[node][ch]
        while node:
            if fail[node] < 0:
                return None
            total += popped[node]
            node = fail[node]
        return total


def model_pieces(path: str) -> list[str]:
    """The normal pieces of a sentencepiece model file (no control, unknown or byte pieces)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]


def count_pieces(
    docs: DataFrame, pieces: list[str], id_col: str = "doc_id", text_col: str = "text", word_mark: str = WORD_MARK
) -> DataFrame:
    """One row per document: id, n_words, n_tokens (an unknown word is one
    token), n_unknown (long). The vocabulary is broadcast: its size is that of
    its file, whatever the corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(list(pieces))
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LongestMatch(shared.value)
        known: dict[bytes, int] = {}  # a bounded cache, not a limit on the vocabulary
        for batch in slices(batches, "text"):
            n_words, n_tokens, n_unknown = [], [], []
            for text in encoded(batch.column(1)):
                words = text.split()
                for word in set(words).difference(known):
                    n = automaton.count(word_mark + word.decode("utf-8", "replace"))
                    known[word] = UNKNOWN + 1 if n is None else n
                total = sum(map(known.__getitem__, words))
                n_words.append(len(words))
                n_tokens.append(total % UNKNOWN)
                n_unknown.append(total // UNKNOWN)
                if len(known) > CACHE_WORDS:
                    known.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_tokens, n_unknown))],
                names=[id_col, "n_words", "n_tokens", "n_unknown"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_tokens long, n_unknown long")
