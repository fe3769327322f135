"""Bounded-space online packing of token sequences.

Each partition keeps a fixed number of open windows. A document is cut into
whole windows and a rest; a whole window is a sequence of its own, a rest is
placed into the open window that it fits best. When none fits and all windows
are in use, the fullest is emitted and a new one opened. Windows still open at
a partition's end are merged, whole, by the same rule in ever larger groups of
partitions until one group is left, so no task ever holds more than a fixed
number of open windows.

Null and empty texts are documents of the end token alone. Repeated rows are
packed each on its own. Very long texts are cut into pieces of one sequence each.
An empty table gives no rows. Other columns are not kept.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship_by_value, slices, written

ship_by_value(__name__)

WINDOWS_PER_MERGE = 4096


class IdEncoder:
    """Token ids of a byte-level BPE file, as little-endian 32-bit bytes.

    Texts within Latin-1 go through the faster of the two installed encoders
    over the very same vocabulary, whose merge ranks are its ids; the two agree
    there (the tests compare them). Other texts, whose character classes may
    depend on an engine's Unicode version, go through the file's own tokenizer.
    """

    def __init__(self, tokenizer_json: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(tokenizer_json)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        special = {t.content for t in self.model.get_added_tokens_decoder().values()}
        # byte-level files spell byte b as chr(b) where that is printable, else as the next free code from 256
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        ranks = {
            bytes(byte_of[ch] for ch in token): i for token, i in self.model.get_vocab().items() if token not in special
        }
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            ids = self.model.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


class OpenWindows:
    """At most ``limit`` open windows of ``size``; ``place`` returns the window
    that took the item and, when one had to go, the emitted window's number."""

    def __init__(self, size: int, limit: int) -> None:
        self.size, self.limit, self.made = size, limit, 0
        self.room: list[tuple[int, int]] = []  # (free, -number), ascending: the first is the fullest
        self.fill: dict[int, int] = {}

    def place(self, length: int) -> tuple[int, int, int | None]:
        """(window, offset in it, emitted window or None)."""
        at = bisect_right(self.room, (length, -(1 << 62)))
        out = None
        if at < len(self.room):
            free, number = self.room.pop(at)
            number = -number
        else:
            if len(self.room) == self.limit:
                out = -self.room.pop(0)[1]
                del self.fill[out]
            number, free = self.made, self.size
            self.made += 1
            self.fill[number] = 0
        offset = self.fill[number]
        self.fill[number] += length
        if free > length:
            insort(self.room, (free - length, -number))
        else:
            del self.fill[number]  # full
        return number, offset, out


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, part int, sequence long, offset long, open boolean"


def _pack_partition(
    rows: Iterator[pa.RecordBatch], encode: Callable[[str], bytes], end_id: bytes, size: int, limit: int, id_col: str
) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    windows = OpenWindows(size, limit)
    waiting: dict[int, list[tuple]] = {}  # pieces of open windows; at most limit * size of them
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "part", "sequence", "offset", "open"]
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.int64(), pa.bool_()]

    def batch(found: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*found)) if found else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], id_type), *(pa.array(c, k) for c, k in zip(columns[1:], kinds))], names=names
        )

    id_type = None
    for rows_in in slices(rows, "text"):
        id_type = rows_in.column(0).type
        found: list[tuple] = []
        for doc, text in zip(rows_in.column(0).to_pylist(), rows_in.column(1).to_pylist()):
            ids = encode(text or "") + end_id
            n = len(ids) // 4
            for start in range(0, n, size):
                own = ids[4 * start : 4 * (start + size)]
                length = len(own) // 4
                number, offset, out = (
                    windows.place(length) if length < size else (windows.made, 0, None)
                )
                piece = (doc, start, length, zlib.crc32(own), n, part, number, offset)
                if length == size:
                    windows.made += 1
                    found.append((*piece, False))
                    continue
                waiting.setdefault(number, []).append(piece)
                for done in {out, number if number not in windows.fill else None} - {None}:
                    found.extend((*p, False) for p in waiting.pop(done))
        yield batch(found, id_type)
    if waiting:
        yield batch([(*p, True) for pieces in waiting.values() for p in pieces], id_type)


def _merge_group(size: int, limit: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Packs whole windows (columns part, sequence, fill) into shared windows:
    target (part, sequence) of the window that each goes to, and its shift."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["fill", "part", "sequence"], ascending=[False, True, True]).reset_index(drop=True)
        windows = OpenWindows(size, limit)
        owner: dict[int, tuple[int, int]] = {}
        rows = []
        for part, sequence, fill in zip(group["part"], group["sequence"], group["fill"]):
            number, offset, _ = windows.place(int(fill))
            to = owner.setdefault(number, (int(part), int(sequence)))
            rows.append((int(part), int(sequence), to[0], to[1], offset))
        still = {owner[n] for n in windows.fill}
        return pd.DataFrame(
            [(*r, (r[2], r[3]) in still) for r in rows],
            columns=["part", "sequence", "to_part", "to_sequence", "shift", "to_open"],
        )

    return run


def pack(
    docs: DataFrame, tokenizer_json: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1024,
    open_windows: int = 128, end_id: int = 0,
) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Every token lies in one piece; a sequence has at most ``size`` tokens. The
    tokenizer file's text and the pattern that splits text before its merges are
    broadcast (their size does not depend on the data).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((tokenizer_json, pattern))
    end = end_id.to_bytes(4, "little")
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pack_partition(iter(batches), IdEncoder(*shared.value).encode, end, size, open_windows, id_col)

    # Written once: tokenizing is the costly part, and the merge reads it several times.
    pieces = written(rows.mapInArrow(run, f"`{id_col}` {kind}, {PIECES}"), "packed")
    closed = pieces.filter(~F.col("open"))
    left = pieces.filter("open")
    groups = pieces.select(F.max("part")).first()[0]
    # Merge leftovers: each round shares windows within groups of partitions, so the
    # windows in a task are bounded and the rounds grow with the logarithm of the partitions.
    per_group = max(2, WINDOWS_PER_MERGE // open_windows)
    span = 1
    while groups is not None and (span == 1 or groups // span > 0):
        span *= per_group
        fills = left.groupBy("part", "sequence").agg(F.sum("length").alias("fill"))
        moves = (
            fills.groupBy(F.floor(F.col("part") / span).alias("group"))
            .applyInPandas(
                _merge_group(size, open_windows),
                "part int, sequence long, to_part int, to_sequence long, shift long, to_open boolean",
            )
        )
        moved = (
            left.join(moves, ["part", "sequence"])
            .withColumn("offset", F.col("offset") + F.col("shift"))
            .withColumn("part", F.col("to_part")).withColumn("sequence", F.col("to_sequence"))
            .withColumn("open", F.col("to_open")).select(*pieces.columns)
        )
        moved = written(moved, "merged")
        closed = closed.unionByName(moved.filter(~F.col("open")))
        left = moved.filter("open")
    return closed.unionByName(left).select(
        F.col(f"`{id_col}`"), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("part").cast("long") * F.lit(1 << 40) + F.col("sequence")).alias("sequence_id"), "offset",
    )
