"""Benchmark decontamination by a prefix-filtered set join.

An item's windows (``window`` consecutive words; a shorter item is one window)
are sets of short shingles, ordered by how rare they are in the corpus. A
document can contain a window only if it holds all its shingles, so the rarest
alone (the prefix for full containment) is joined with the documents' shingles.
A match fixes where the window would begin (positional bound); it must lie in
the document (length bound), and its words are then compared one by one.

A benchmark of up to ``block_bytes``, the usual case, is an index that every
task holds. A larger one stays a table: its shingles set bits in a filter of at
most ``FILTER_BYTES``, through which one pass over the documents counts them
and a second one lets out the places where a prefix may stand, with the words
around; these meet the windows in a join, where the bounds and the words are
checked. Both passes stay two however large the benchmark is.

Null or wordless items have no window; items with a null id are left out. Null
and empty documents have no words, very long ones are taken whole. Repeated rows
of documents are each judged; repeated items count once; an empty table of
either gives no rows or no hits. Columns other than id and text are not kept
(``drop_leaks`` keeps all, of any name).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_row, encoded, row_columns, ship_by_value, slices, text_digest, written

ship_by_value(__name__)

# Bytes of words: digits, letters (A-Z lower-cased) and everything beyond ASCII; the rest separates.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
BLOCK_BYTES = 4 << 20
FILTER_BYTES = 64 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)
SHINGLE = 3
SPANS = "array<struct<start:int,stop:int>>"


def item_words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class WindowIndex:
    """The windows of one block of items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.window = window
        self.word_ids: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            ids = [self.word_ids.setdefault(w, len(self.word_ids)) for w in item_words(text)]
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                owners[tuple(ids[i : i + n])].add(item)
        self.windows = sorted(owners)
        self.owners = [sorted(owners[w]) for w in self.windows]
        self.length = np.array([len(w) for w in self.windows], np.int64)
        self.words = np.full((len(self.windows), window), -2, np.int64)
        for row, w in zip(self.words, self.windows):
            row[: len(w)] = w
        # A window of fewer than SHINGLE words has its first word for a shingle.
        self.by_size = {}
        for size in (SHINGLE, 1):
            rows = np.nonzero(self.length >= SHINGLE if size == SHINGLE else self.length < SHINGLE)[0]
            found = [
                (self._code(self.words[r : r + 1, k : k + size])[0], r, k)
                for r in rows.tolist() for k in range(self.length[r] - size + 1 if size == SHINGLE else 1)
            ]
            codes = np.unique(np.array([f[0] for f in found], np.int64))
            self.by_size[size] = (codes, [(int(np.searchsorted(codes, c)), r, k) for c, r, k in found])
        self.shingles = sum(codes.size for codes, _ in self.by_size.values())

    def _code(self, columns: np.ndarray) -> np.ndarray:
        v = len(self.word_ids) + 1
        code = np.zeros(len(columns), np.int64)
        for k in range(columns.shape[1]):
            code = code * v + columns[:, k]
        return code

    def find(self, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, shingle number) of the block's shingles of ``size`` in a row of word ids."""
        codes = self.by_size[size][0]
        if not codes.size or ids.size < size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = ids >= 0
        n = ids.size - size + 1
        at = np.nonzero(np.logical_and.reduce([known[k : n + k] for k in range(size)]))[0]
        code = self._code(np.stack([ids[at + k] for k in range(size)], axis=1))
        number = np.minimum(np.searchsorted(codes, code), codes.size - 1)
        hit = codes[number] == code
        return at[hit], number[hit]

    def set_prefixes(self, counts: dict[int, np.ndarray]) -> None:
        """Keep of each window its rarest shingle: for each size, the windows
        (and the shingle's place in them) grouped by shingle."""
        self.prefix = {}
        for size, (codes, found) in self.by_size.items():
            best: dict[int, tuple] = {}
            for number, row, place in found:
                rank = (int(counts[size][number]), number, place)
                if row not in best or rank < best[row]:
                    best[row] = rank
            own = sorted((number, row, place) for row, (_, number, place) in best.items())
            number = np.array([o[0] for o in own], np.int64)
            self.prefix[size] = (
                np.searchsorted(number, np.arange(codes.size + 1)),
                np.array([o[1] for o in own], np.int64), np.array([o[2] for o in own], np.int64),
            )

    def ids_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word ids (-1: in no item) of all texts, and each text's number of words;
        ``window`` ids of -1 stand after each text so that no shingle spans two."""
        get, gap = self.word_ids.get, [-1] * self.window
        ids: list[int] = []
        sizes = []
        for text in texts:
            words = item_words(text)
            sizes.append(len(words))
            ids.extend([get(w, -1) for w in words])
            ids.extend(gap)
        return np.array(ids, np.int64), np.array(sizes, np.int64)

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, window) of every window that occurs in ``ids``."""
        starts, rows = [], []
        for size, (first, windows, places) in self.prefix.items():
            at, number = self.find(ids, size)
            n = first[number + 1] - first[number]
            entry = np.repeat(first[number], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            row, start = windows[entry], np.repeat(at, n) - places[entry]
            fits = (start >= 0) & (start + self.length[row] <= ids.size)
            row, start = row[fits], start[fits]
            want = self.words[row]
            place = np.minimum(start[:, None] + np.arange(self.window), ids.size - 1)
            same = ((ids[place] == want) | (want == -2)).all(axis=1)
            starts.append(start[same])
            rows.append(row[same])
        return np.concatenate(starts), np.concatenate(rows)


def _shingle_counts(docs: DataFrame, index, window: int) -> dict[int, np.ndarray]:
    """Occurrences in the corpus of each of a block's shingles (one number per shingle)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        total = {size: np.zeros(codes.size, np.int64) for size, (codes, _) in own.by_size.items()}
        for batch in slices(batches, "text", 2 << 20):
            ids, _ = own.ids_of(encoded(batch.column(0)))
            for size, counts in total.items():
                counts += np.bincount(own.find(ids, size)[1], minlength=counts.size)
        for size, counts in total.items():
            at = np.nonzero(counts)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(at.size, size)), pa.array(at), pa.array(counts[at])], names=["size", "number", "n"]
            )

    rows = docs.select("text").mapInArrow(run, "size long, number long, n long")
    out = {size: np.zeros(codes.size, np.int64) for size, (codes, _) in index.value.by_size.items()}
    for size, number, n in rows.groupBy("size", "number").agg(F.sum("n")).collect():  # bounded by the block
        out[size][number] = n
    return out


def _search(docs: DataFrame, index, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in slices(batches, "text", 2 << 20):
            ids, sizes = own.ids_of(encoded(batch.column(2)))
            first = np.cumsum(sizes + own.window) - sizes - own.window
            start, row = own.occurrences(ids)
            cover = np.zeros(ids.size + 1, np.int64)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + own.length[row], -1)
            hit = np.concatenate(([0], (np.cumsum(cover) > 0).astype(np.int8)))
            step = np.diff(hit)
            spans: dict[int, list] = defaultdict(list)
            for a, b in zip(np.nonzero(step == 1)[0].tolist(), np.nonzero(step == -1)[0].tolist()):
                doc = int(np.searchsorted(first, a, side="right")) - 1
                spans[doc].append({"start": a - int(first[doc]), "stop": b - int(first[doc])})
            items: dict[int, set] = defaultdict(set)
            docs_of = np.searchsorted(first, start, side="right") - 1
            for doc, r in {(int(d), int(r)) for d, r in zip(docs_of, row)}:
                items[doc].update(own.owners[r])
            at = range(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes),
                 pa.array([spans.get(i, []) for i in at], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                 pa.array([sorted(items.get(i, ())) for i in at], pa.list_(pa.string()))],
                names=["id", "digest", "n_words", "spans", "items"],
            )

    return docs.select("id", "digest", "text").mapInArrow(
        run, f"id {kind}, digest long, n_words long, spans {SPANS}, items array<string>"
    )


def merged_spans(spans: Column) -> Column:
    """Overlapping and touching spans made one."""
    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))),
        )
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["stop"] >= x["start"]), joined).otherwise(
            F.concat(done, F.array(x))
        )

    return F.aggregate(F.array_sort(spans), F.expr(f"cast(array() as {SPANS})"), add)


def shingle_codes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit code for each ``size`` consecutive word hashes."""
    n = hashes.size - size + 1
    code = np.full(max(n, 0), size, np.uint64)
    for k in range(size if n > 0 else 0):
        code = (code ^ hashes[k : n + k]) * ODD
        code ^= code >> np.uint64(29)
    return code


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _bits(code: np.ndarray) -> np.ndarray:
    """Two bits of a filter's word for each code."""
    one = np.uint64(1)
    return (one << (code >> np.uint64(58))) | (one << ((code >> np.uint64(52)) & np.uint64(63)))


class CodeFilter:
    """A filter of codes: about 16 bits for each, ``FILTER_BYTES`` at most."""

    def __init__(self, codes: DataFrame) -> None:
        distinct = codes.select("code").distinct()
        self.words = int(min(FILTER_BYTES // 8, 1 + distinct.count() // 4))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                code = batch.column(0).to_numpy().view(np.uint64)
                at = (code % np.uint64(self.words)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(_bits(code).view(np.int64))], names=["at", "bits"])

        # bounded by the filter's size
        table = distinct.mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
        self.table = np.zeros(self.words, np.uint64)
        self.table[table["at"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)

    def maybe(self, code: np.ndarray) -> np.ndarray:
        bits = _bits(code)
        return self.table[(code % np.uint64(self.words)).astype(np.int64)] & bits == bits


def _bench_windows(bench: DataFrame, window: int) -> DataFrame:
    """(item, win, n): the windows of all items, words joined by a blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            items, wins, sizes = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), encoded(batch.column(1))):
                words = item_words(text)
                n = min(window, len(words))
                for i in range(len(words) - n + 1 if n else 0):
                    items.append(item)
                    wins.append(b" ".join(words[i : i + n]).decode())
                    sizes.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(wins, pa.string()), pa.array(sizes, pa.int32())], names=["item", "win", "n"])

    return bench.mapInArrow(run, "item string, win string, n int").distinct()


def _window_shingles(windows: DataFrame) -> DataFrame:
    """(code, place, win, n): the shingles of each window; one of fewer words has its first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, places, rows = [], [], []
            for row, win in enumerate(batch.column(0).to_pylist()):
                words = win.encode().split(b" ")
                code = shingle_codes(_hashes(words), SHINGLE) if len(words) >= SHINGLE else shingle_codes(_hashes(words[:1]), 1)
                codes.append(code)
                places += range(code.size)
                rows += [row] * code.size
            code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
            own = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(code.view(np.int64)), pa.array(places, pa.int32()), *own.columns], names=["code", "place", "win", "n"])

    return windows.mapInArrow(run, "code long, place int, win string, n int")


def _code_counts(docs: DataFrame, wanted) -> DataFrame:
    """(code, count) over the corpus, of the codes that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            found = []
            for text in encoded(batch.column(0)):
                hashes = _hashes(item_words(text))
                for size in (SHINGLE, 1):
                    code = shingle_codes(hashes, size)
                    found.append(code[wanted.value.maybe(code)])
            code, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(n)], names=["code", "count"])

    return docs.select("text").mapInArrow(run, "code long, count long").groupBy("code").agg(F.sum("count").alias("count"))


def _prefix_places(docs: DataFrame, wanted, window: int, kind: str) -> DataFrame:
    """A row (id, digest, n_words) for each document, and (id, digest, code, at,
    before, around) for each place where a prefix may stand: the words around it,
    and how many of them come before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "digest", "n_words", "code", "at", "before", "around"]
        for batch in slices(batches, "text", 1 << 20):
            sizes, rows, codes, places, before, around = [], [], [], [], [], []
            for row, text in enumerate(encoded(batch.column(2))):
                words = item_words(text)
                sizes.append(len(words))
                hashes = _hashes(words)
                for size in (SHINGLE, 1):
                    code = shingle_codes(hashes, size)
                    for i in np.nonzero(wanted.value.maybe(code))[0].tolist():
                        low = max(0, i - window + 1)
                        rows.append(row)
                        codes.append(code[i])
                        places.append(i)
                        before.append(i - low)
                        around.append(b" ".join(words[low : i + window]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), *(pa.nulls(len(sizes), t) for t in (
                    pa.int64(), pa.int32(), pa.int32(), pa.string()))], names=names)
            own = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [own.column(0), own.column(1), pa.nulls(len(rows), pa.int64()), pa.array(np.array(codes, np.uint64).view(np.int64)),
                 pa.array(places, pa.int32()), pa.array(before, pa.int32()), pa.array(around, pa.string())], names=names)

    return docs.select("id", "digest", "text").mapInArrow(
        run, f"id {kind}, digest long, n_words long, code long, at int, before int, around string")


def _joined_leaks(rows: DataFrame, bench: DataFrame, window: int, kind: str) -> DataFrame:
    """``find_leaks`` for a benchmark that no task holds."""
    broadcast = rows.sparkSession.sparkContext.broadcast
    windows = written(_bench_windows(bench, window), "bench-windows")
    shingles = written(_window_shingles(windows.select("win", "n").distinct()), "bench-shingles")
    counts = _code_counts(rows, broadcast(CodeFilter(shingles)))
    rank = F.struct(F.coalesce("count", F.lit(0)).alias("count"), "code", "place")
    prefix = shingles.join(counts, "code", "left").groupBy("win", "n").agg(F.min(rank).alias("best"))
    prefix = written(prefix.select("best.code", "best.place", "win", "n"), "bench-prefixes")
    places = written(_prefix_places(rows, broadcast(CodeFilter(prefix)), window, kind), "prefix-places")
    near = places.filter("code is not null").drop("n_words").join(prefix, "code")
    # the window begins in the document, and its words are these
    fits = "before >= place AND array_join(slice(split(around, ' '), greatest(before - place, 0) + 1, n), ' ') = win"
    hits = written(near.filter(fits).selectExpr("id", "digest", "at - place AS start", "at - place + n AS stop", "win").distinct(), "hits")
    spans = hits.groupBy("id", "digest").agg(merged_spans(F.collect_set(F.struct("start", "stop"))).alias("_spans"))
    items = hits.select("id", "digest", "win").distinct().join(windows.select("win", "item"), "win")
    items = items.groupBy("id", "digest").agg(F.array_sort(F.collect_set("item")).alias("_items"))
    found = places.filter("code is null").select("id", "digest", "n_words")
    for table, name, none in ((spans, "spans", SPANS), (items, "items", "array<string>")):
        own = table.withColumnsRenamed({"id": "_id", "digest": "_d"})
        found = found.join(own, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_d")), "left")
        found = found.withColumn(name, F.coalesce(f"_{name}", F.array().cast(none))).drop("_id", "_d", f"_{name}")
    return found


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, digest, n_words, spans (word ranges
    covered by an occurring window) and items (ids of their items, as strings)."""
    spark = docs.sparkSession
    rows = docs.select(
        docs[id_col].alias("id"), text_digest(docs[text_col]).alias("digest"), docs[text_col].cast("string").alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()
    bench = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    bench = bench.filter("item is not null and text is not null").distinct()
    if (bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > block_bytes:
        return _joined_leaks(rows, bench, window, kind)
    index = WindowIndex([(r["item"], r["text"].encode()) for r in bench.toLocalIterator()], window)
    shared = spark.sparkContext.broadcast(index)
    index.set_prefixes(_shingle_counts(rows, shared, window))
    return _search(rows, spark.sparkContext.broadcast(index), kind)


def drop_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """``docs`` without the documents that hold a window of a benchmark item; all columns stay."""
    leaks = find_leaks(docs, items, id_col, text_col, **options).filter(F.size("items") > 0)
    leaks = written(leaks.select(F.col("id").alias("_id"), F.col("digest").alias("_d")).distinct(), "leaks")
    marked = as_row(docs, F.col(id_col).alias("_own"), text_digest(F.col(text_col)).alias("_digest"))
    on = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_d"))
    return marked.join(leaks, on, "left_anti").select(*row_columns(docs))
