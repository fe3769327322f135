"""Substring dedup by repeated-phrase automata.

A window is ``window`` consecutive words of a document. A word is removed when
a window over it also starts in a document with a smaller id; windows are
judged on the input.

1. Seeds. Of the ``seed``-word shingles in each window the one with the least
   hash is its seed, so equal windows have equal seeds, and neighbouring windows
   mostly share one. A seed that stands in one document only cannot belong to a
   recurring window; the rest are given back to their documents.
2. Fragments. A document's words around each remaining seed (all windows that
   have it) go to the shard of the seed; windows of very frequent seeds go one
   by one, by their own hash, so no shard gathers unlike windows without bound.
3. Automata. Each shard takes its fragments in blocks of bounded size: windows
   found in two documents are confirmed word by word and compiled into an
   Aho-Corasick automaton over word numbers, through which all fragments of the
   block are streamed; every occurrence after the first document is reported.
4. The reported word ranges of a document are removed together.

Ids are integers. A document with a null id is left as it is and is no source;
null and empty texts have no words; rows that repeat an id are one document to
each other and are all treated; very long texts are taken whole; an empty table
gives no rows; all other columns, of any name, come back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ROW, encoded, row_columns, ship_by_value, slices, text_digest

ship_by_value(__name__)

SEED_WORDS = 5
FREQUENT = 4096  # rows with a seed; from here on its windows are dealt one by one
BLOCK = 16384  # fragments for which one automaton is compiled
PLACE = "id long, digest long, start int, stop int"
ODD = np.uint64(0x9E3779B97F4A7C15)


def window_seeds(words: list[list[bytes]], window: int, seed: int) -> tuple[np.ndarray, ...]:
    """For all windows of all texts in turn: (text, first word, seed hash, seed place)."""
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((xxhash.xxh64_intdigest(x) for w in words for x in w), np.uint64, int(sizes.sum()))
    none = np.zeros(0, np.int64)
    if flat.size < window:
        return none, none, none.view(np.uint64), none
    n = flat.size - seed + 1
    shingle = np.zeros(n, np.uint64)
    for k in range(seed):
        shingle = (shingle ^ flat[k : n + k]) * ODD
        shingle ^= shingle >> np.uint64(29)
    m = flat.size - window + 1
    best, place = shingle[:m].copy(), np.zeros(m, np.int64)
    for k in range(1, window - seed + 1):
        less = shingle[k : m + k] < best
        best[less] = shingle[k : m + k][less]
        place[less] = k
    text = np.repeat(np.arange(sizes.size), sizes)
    start = np.nonzero(text[:m] == text[window - 1 :])[0]
    first = np.cumsum(sizes) - sizes
    owner = text[start]
    return owner, start - first[owner], best[start], start + place[start] - first[owner]


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the row before."""
    new = np.ones(columns[0].size, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.nonzero(new)[0]


def _emit_seeds(batches: Iterator[pa.RecordBatch], window: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 2 << 20):
        words = [t.split() for t in encoded(batch.column(1))]
        text, _, value, place = window_seeds(words, window, seed)
        at = _runs(text, place) if text.size else text  # the fragments that there may be
        at = at[np.lexsort((value[at], text[at]))]
        text, value = text[at], value[at]
        first = _runs(text, value) if text.size else text  # one row for a seed of a document, with their number
        ids = batch.column(0).to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(value[first].view(np.int64)), pa.array(ids[text[first]]),
             pa.array(np.diff(np.append(first, text.size)).astype(np.int32))], names=["seed", "id", "k"],
        )


def _emit_fragments(batches: Iterator[pa.RecordBatch], window: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Input (id, digest, text, seeds, frequent); output (key, id, digest, start, words)."""
    for batch in slices(batches, "text", 2 << 20):
        batch = batch.filter(batch.column(3).is_valid())
        if not batch.num_rows:
            continue
        words = [t.split() for t in encoded(batch.column(2))]
        text, start, value, place = window_seeds(words, window, seed)
        at = _runs(text, place) if text.size else text
        stop = np.append(at[1:], text.size)
        wanted, frequent = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        ids, digests = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        keys, docs, starts, parts = [], [], [], []
        cuts = np.searchsorted(text[at], np.arange(len(words) + 1))
        for d in range(len(words)):
            own, often, mine = set(wanted[d]), set(frequent[d]), words[d]
            span = slice(cuts[d], cuts[d + 1])
            for a, b in zip(at[span].tolist(), stop[span].tolist()):
                key = int(value[a].view(np.int64))
                if key in own:
                    i = int(start[a])
                    keys.append(key)
                    docs.append(d)
                    starts.append(i)
                    parts.append(b" ".join(mine[i : i + b - a + window - 1]))
                elif key in often:
                    for i in range(int(start[a]), int(start[a]) + b - a):
                        part = b" ".join(mine[i : i + window])
                        keys.append(xxhash.xxh64_intdigest(part, 1) - (1 << 63))
                        docs.append(d)
                        starts.append(i)
                        parts.append(part)
        docs = np.array(docs, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(ids[docs]), pa.array(digests[docs]), pa.array(starts, pa.int32()),
             pa.array(parts, pa.binary())], names=["key", "id", "digest", "start", "words"],
        )


class Block:
    """Fragments of consecutive keys, equal fragments of a key held once."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.rows: dict[tuple[int, bytes], list[tuple[int, int, int]]] = {}
        self.size = 0

    def add(self, key: int, part: bytes, row: tuple[int, int, int]) -> None:
        self.rows.setdefault((key, part), []).append(row)
        self.size += 1

    def occurrences(self, carried: dict[bytes, int]) -> tuple[list[tuple[int, int, int, int]], dict[bytes, int]]:
        """Reported (id, digest, start, stop), and the first document of every
        window of the last key, for the block in which that key goes on.
        ``carried`` is the same of the block before, for the first key."""
        import ahocorasick

        number: dict[bytes, int] = {}
        first: dict[tuple[int, ...], int] = {}
        last: dict[tuple[int, ...], int] = {}
        n = self.window

        def ids_of(part: bytes) -> tuple[int, ...]:
            return tuple([number.setdefault(w, len(number) + 1) for w in part.split(b" ")])

        def seen(w: tuple[int, ...], low: int, high: int) -> None:
            first[w] = min(low, first.get(w, low))
            last[w] = max(high, last.get(w, high))

        for part, doc in carried.items():
            seen(ids_of(part), doc, doc)
        streamed: list[tuple[tuple[int, ...], list[tuple[int, int, int]]]] = []
        for key, group in groupby(self.rows.items(), lambda item: item[0][0]):
            parts = [(ids_of(part), rows) for (_, part), rows in group]  # rows come in order of their ids
            one_passage = len(parts) == 1 and not carried
            if one_passage and parts[0][1][0][0] == parts[0][1][-1][0]:
                continue  # in one document only
            streamed += parts
            for ids, rows in parts:
                # where all fragments of a seed are alike, the passage is one phrase; else each window is
                size = len(ids) if one_passage else n
                for i in range(len(ids) - size + 1):
                    seen(ids[i : i + size], rows[0][0], rows[-1][0])
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for phrase, doc in first.items():
            if last[phrase] != doc:  # confirmed: the same words in two documents
                automaton.add_word(phrase, (len(phrase), doc))
        found: list[tuple[int, int, int, int]] = []
        if len(automaton):
            automaton.make_automaton()
            for ids, rows in streamed:
                hits = [(end - size + 1, end + 1, doc) for end, (size, doc) in automaton.iter(ids)]
                if not hits:
                    continue
                every = merged([(a, b) for a, b, _ in hits])
                newest, oldest = max(h[2] for h in hits), min(h[2] for h in hits)
                for doc, digest, start in rows:
                    if doc > newest:
                        spans = every
                    elif doc > oldest:
                        spans = merged([(a, b) for a, b, own in hits if own < doc])
                    else:
                        continue
                    found.extend([(doc, digest, start + a, start + b) for a, b in spans])
        return found, first_words(self.rows, n, carried)


def first_words(rows: dict, n: int, carried: dict[bytes, int]) -> dict[bytes, int]:
    """First document of each window of the last key in ``rows`` (a key that is
    the only one may have come over from the block before)."""
    last_key = next(reversed(rows))[0] if rows else None
    out = dict(carried) if rows and next(iter(rows))[0] == last_key else {}
    for key, part in reversed(rows):
        if key != last_key:
            break
        words, low = part.split(b" "), rows[key, part][0][0]
        for i in range(len(words) - n + 1):
            window = b" ".join(words[i : i + n])
            out[window] = min(low, out.get(window, low))
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans, in order of their starts, made one."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _locate(batches: Iterator[pa.RecordBatch], window: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Input (key, id, digest, start, words) sorted by (key, id)."""
    block, carried, key_before = Block(window), {}, None

    def out(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
        ids, digests, starts, stops = zip(*found) if found else ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(digests, pa.int64()), pa.array(starts, pa.int32()),
             pa.array(stops, pa.int32())], names=["id", "digest", "start", "stop"],
        )

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for key, doc, digest, start, part in zip(*columns):
            if block.size >= limit and (key != key_before or block.size >= 2 * limit):
                found, first = block.occurrences(carried)
                carried = first if key == key_before else {}
                block = Block(window)
                yield out(found)
            block.add(key, part, (doc, digest, start))
            key_before = key
    if block.size:
        yield out(block.occurrences(carried)[0])


def _finish(batches: Iterator[pa.RecordBatch], with_text: bool, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Input (..., digest, text, spans); output the leading columns, n_words,
    n_removed, spans and the kept text (or its words' SHA-256)."""
    one_word = re.compile(rb"[^\x20\x09-\x0d]+")
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    for batch in slices(batches, "_text", 2 << 20):
        at = {c: i for i, c in enumerate(batch.schema.names)}
        texts = encoded(batch.column(at["_text"]))
        digests = batch.column(at["_digest"]).to_pylist()
        marks = batch.column(at["_marks"]).to_pylist()
        n_words, n_removed, spans, kept = [], [], [], []
        for text, digest, mark in zip(texts, digests, marks):
            words = text.split()
            own = merged(sorted((m["start"], m["stop"]) for m in mark or () if m["digest"] == digest))
            n_words.append(len(words))
            n_removed.append(sum(b - a for a, b in own))
            spans.append([{"start": a, "stop": b} for a, b in own])
            if with_text:
                if not own:
                    kept.append(text)
                    continue
                places = [m.span() for m in one_word.finditer(text)]
                parts, done = [], 0
                for a, b in own:  # the blanks before a removed run stay, those inside and behind it go
                    parts.append(text[done : places[a][0]])
                    done = places[b][0] if b < len(places) else places[b - 1][1]
                kept.append(b"".join(parts) + text[done:])
            else:
                left, done = [], 0
                for a, b in own:
                    left += words[done:a]
                    done = b
                kept.append(hashlib.sha256(b" ".join(left + words[done:])).hexdigest())
        lead = [batch.column(at[c]) for c in names]
        last = pa.array([k.decode() for k in kept] if with_text else kept, pa.string())
        yield pa.RecordBatch.from_arrays(
            [*lead, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, span_type), last],
            names=[*names, "_n_words", "_n_removed", "_spans", "_kept"],
        )


def repeated_phrases(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, seed: int = SEED_WORDS,
    frequent: int = FREQUENT, block: int = BLOCK, with_text: bool = False,
) -> DataFrame:
    """A struct of all columns of ``docs`` but the text, then _n_words, _n_removed,
    _spans (word ranges removed) and _kept: SHA-256 of the kept words, or the kept text."""
    names = [c for c in docs.columns if c != text_col]
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias(ROW), F.col(id_col).cast("long").alias("_id"),
        text_digest(F.col(text_col)).alias("_digest"), F.col(text_col).cast("string").alias("_text"),
    )
    narrow = held.filter("_id is not null").select(F.col("_id").alias("id"), F.col("_text").alias("text"))
    seeds = narrow.mapInArrow(lambda b: _emit_seeds(b, window, seed), "seed long, id long, k int")
    by_seed = Window.partitionBy("seed")
    recurring = (
        seeds.withColumn("low", F.min("id").over(by_seed)).withColumn("high", F.max("id").over(by_seed))
        .withColumn("n", F.sum("k").over(by_seed)).filter("low < high")
    )
    lists = recurring.groupBy(F.col("id").alias("_own")).agg(
        F.collect_set(F.when(F.col("n") <= frequent, F.col("seed"))).alias("seeds"),
        F.collect_set(F.when(F.col("n") > frequent, F.col("seed"))).alias("often"),
    )
    # Both joins below deal the texts by id in the same way: one shuffle, read twice.
    asked = held.join(lists, F.col("_id") == F.col("_own"), "left")
    fragments = asked.select(
        *[F.col(f"`{c}`") for c in held.columns], "seeds", "often"
    ).mapInArrow(
        lambda b: _emit_fragments(
            (x.select(["_id", "_digest", "_text", "seeds", "often"]).rename_columns(["id", "digest", "text", "seeds", "often"]) for x in b),
            window, seed,
        ),
        "key long, id long, digest long, start int, words binary",
    )
    places = (
        fragments.repartition("key").sortWithinPartitions("key", "id", "start")
        .mapInArrow(lambda b: _locate(b, window, block), PLACE)
    )
    marks = places.groupBy(F.col("id").alias("_own")).agg(F.collect_list(F.struct("digest", "start", "stop")).alias("_marks"))
    joined = held.join(marks, F.col("_id") == F.col("_own"), "left").select(
        *[F.col(f"`{c}`") for c in held.columns], "_marks"
    )
    made = {"_n_words": "long", "_n_removed": "long", "_spans": "array<struct<start:int,stop:int>>", "_kept": "string"}
    schema = joined.select(ROW, *[F.lit(None).cast(kind).alias(c) for c, kind in made.items()]).schema
    return joined.mapInArrow(lambda b: _finish(b, with_text, [ROW]), schema)


def drop_repeated_phrases(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, **options
) -> DataFrame:
    """``docs`` with every repeated passage after its first document cut out of
    the texts; all columns and rows stay (a null text becomes empty)."""
    kept = repeated_phrases(docs, id_col, text_col, window, with_text=True, **options)
    return kept.select(*row_columns(docs, **{text_col: F.col("_kept")}))
