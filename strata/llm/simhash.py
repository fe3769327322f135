"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint's 64 bits are three segments. Decoding a segment, and every
vector one bit from it, with the perfect binary Golay code gives one to six
codeword indices; segments at most two bits apart share an index. Of at most
four differing bits, some segment holds at most two while those outside it
fall into at most two of the four half-segments there: each fingerprint
therefore gets a key for every segment, every codeword index of it and every
pair of half-segments outside it, and linked fingerprints share a key.
Fingerprints of a key are compared exactly; a key's links are given as a
spanning forest, so a group of copies costs as many rows as it has members.

Equal fingerprints are one fingerprint from the start. Null and empty texts
have fingerprint zero and are linked like any other. Repeated rows fall into
one component. Null ids never become a component's id unless it has no other.
Very long texts are taken whole; an empty table gives no rows. ``near_duplicates``
keeps no other columns, ``drop_near_duplicates`` all of them, of any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_row, encoded, row_columns, ship_by_value, slices, text_digest, written
from strata.llm.components import connected_components

ship_by_value(__name__)

SEED = 42
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, length
DISTANCE = 4  # what the keys above are proved for
KEY_MEMBERS = 1 << 17  # a larger group is split by further bits


def fingerprint(words: list[bytes], size: int) -> int:
    """Bits set in over half the hashes of the ``size``-word shingles."""
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-size])).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[i:j], SEED) for i, j in zip(starts, (ends[size - 1 :] - 1).tolist())]
    n = len(hashes)
    rows = np.zeros(-(-n // 255) * 255, np.uint64)
    rows[:n] = hashes
    rows = rows.reshape(-1, 255)  # 255 hashes fill eight one-byte counters of a sum at most
    out = 0
    for k in range(8):
        lanes = ((rows >> np.uint64(k)) & np.uint64(0x0101010101010101)).sum(axis=1, dtype=np.uint64)
        counts = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for j in np.nonzero(counts * 2 > n)[0].tolist():
            out |= 1 << (8 * j + k)
    return out


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and the error of each syndrome."""
    unit = []
    for i in range(23):
        v = 1 << i
        for top in range(22, 10, -1):
            if v >> top & 1:
                v ^= GENERATOR << (top - 11)
        unit.append(v)
    low, high, error = np.zeros(4096, np.int64), np.zeros(2048, np.int64), np.zeros(2048, np.int64)
    for i in range(12):
        low[np.arange(4096) >> i & 1 == 1] ^= unit[i]
    for i in range(11):
        high[np.arange(2048) >> i & 1 == 1] ^= unit[12 + i]
    for weight in range(1, 4):
        for bits in combinations(range(23), weight):
            error[np.bitwise_xor.reduce([unit[i] for i in bits])] = sum(1 << i for i in bits)
    return low, high, error


def nearby_codewords(values: np.ndarray, length: int, tables: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(row, index): the distinct indices of the codewords to which a value of
    ``length`` bits, or one a single bit from it, decodes."""
    low, high, error = tables
    flips = np.array([0, *(1 << i for i in range(length))], np.int64)
    near = values[:, None] ^ flips
    index = np.sort((near ^ error[low[near & 4095] ^ high[near >> 12]]) >> 11, axis=1)
    new = np.ones(index.shape, bool)
    new[:, 1:] = index[:, 1:] != index[:, :-1]
    row, at = np.nonzero(new)
    return row, index[row, at]


def halves(segment: int) -> list[tuple[int, int]]:
    first, length = SEGMENTS[segment]
    cut = (length + 1) // 2
    return [(first, cut), (first + cut, length - cut)]


def arrangements() -> list[tuple[int, tuple[int, int], tuple[int, int]]]:
    """(segment to decode, two half-segments outside it that must be equal)."""
    out = []
    for s in range(3):
        outside = [h for t in range(3) if t != s for h in halves(t)]
        out.extend((s, a, b) for a, b in combinations(outside, 2))
    return out


def _part(prints: np.ndarray, first: int, length: int) -> np.ndarray:
    return (prints >> np.uint64(first) & np.uint64((1 << length) - 1)).astype(np.int64)


def golay_keys(prints: np.ndarray, tables: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, fingerprints) for each arrangement; the key begins with its number."""
    decoded = [nearby_codewords(_part(prints, *SEGMENTS[s]), SEGMENTS[s][1], tables) for s in range(3)]
    for number, (s, a, b) in enumerate(arrangements()):
        row, index = decoded[s]
        equal = _part(prints, *a) << 11 | _part(prints, *b)
        yield (number << 34) | (index << 22) | equal[row], prints[row]


def equal_bits(key: int) -> int:
    """Mask of the bits that all fingerprints of a first-level key share."""
    _, a, b = arrangements()[key >> 34]
    return ((1 << a[1]) - 1) << a[0] | ((1 << b[1]) - 1) << b[0]


def spanning_links(prints: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray]]:
    """(fingerprint, those newly reached from it): a spanning forest of all
    pairs within ``distance``. What is reached leaves the set, so a tight group
    is done in about one pass."""
    todo = prints
    while todo.size > 1:
        front, todo = [todo[0]], todo[1:]
        while front and todo.size:
            at = front.pop()
            near = np.bitwise_count(todo ^ at) <= distance
            if near.any():
                reached = todo[near]
                yield at, reached
                front.extend(reached)
                todo = todo[~near]


def _links_of_keys(batches: Iterator[pa.RecordBatch], distance: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Input (key, mask, print) sorted by key. Output (a, b, mask, late): links,
    and members (key, print) of keys with more than ``limit`` fingerprints."""
    names = ["a", "b", "mask", "late"]

    def out(a, b, mask, late: bool) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(a).view(np.int64)), pa.array(np.asarray(b).view(np.int64)),
             pa.array(np.broadcast_to(np.int64(mask), n).copy()), pa.array(np.full(n, late))], names=names,
        )

    def links(prints: np.ndarray) -> tuple[list, list]:
        a, b = [], []
        for one, many in spanning_links(prints, distance):
            a.append(np.full(many.size, one, np.uint64))
            b.append(many)
        return a, b

    held = np.zeros(0, np.uint64)
    held_key, held_mask, flooding = None, 0, False
    for batch in batches:
        keys = batch.column(0).to_numpy()
        masks = batch.column(1).to_numpy()
        prints = batch.column(2).to_numpy().view(np.uint64)
        if not keys.size:
            continue
        cuts = np.concatenate(([0], np.nonzero(keys[1:] != keys[:-1])[0] + 1, [keys.size]))
        sizes = np.diff(cuts)
        found_a, found_b = [], []
        # whole pairs in the middle of the batch, at once
        inner = np.arange(1, sizes.size - 1)
        twos = cuts[inner[sizes[inner] == 2]]
        ok = np.bitwise_count(prints[twos] ^ prints[twos + 1]) <= distance
        found_a.append(prints[twos[ok]])
        found_b.append(prints[twos[ok] + 1])
        groups = [0, *inner[sizes[inner] > 2].tolist(), *([sizes.size - 1] if sizes.size > 1 else [])]
        for g in groups:
            own, key = prints[cuts[g] : cuts[g + 1]], keys[cuts[g]]
            if key != held_key:
                if not flooding:
                    a, b = links(held)
                    found_a += a
                    found_b += b
                held, held_key, held_mask, flooding = own, key, masks[cuts[g]], False
            else:
                held = own if flooding else np.concatenate((held, own))
            if flooding or held.size > limit:
                yield out(np.full(held.size, held_key, np.int64), held, held_mask, True)
                held, flooding = held[:0], True
        if any(x.size for x in found_a):
            yield out(np.concatenate(found_a), np.concatenate(found_b), 0, False)
    a, b = links(held) if not flooding else ([], [])
    if a:
        yield out(np.concatenate(a), np.concatenate(b), 0, False)


def _refined(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Members (key, mask, print) of too large keys, by one of ``distance + 1``
    runs of the bits not yet equal: one of these has no differing bit."""
    for batch in batches:
        keys, masks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        prints = batch.column(2).to_numpy().view(np.uint64)
        for mask in np.unique(masks).tolist():
            rows = masks == mask
            free = [i for i in range(64) if not mask >> i & 1]
            for run in np.array_split(free, distance + 1):
                bits = sum(1 << int(i) for i in run)
                part = prints[rows] & np.uint64(bits)
                mixed = [
                    xxhash.xxh64_intdigest(f"{k}/{bits}/{p}") for k, p in zip(keys[rows].tolist(), part.tolist())
                ]
                wider = mask % (1 << 64) | bits
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(mixed, np.uint64).view(np.int64)),
                     pa.array(np.full(part.size, wider, np.uint64).view(np.int64)),
                     pa.array(prints[rows].view(np.int64))], names=["key", "mask", "print"],
                )


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, digest, print): one row per row of ``docs``."""
    rows = docs.select(
        docs[id_col].alias("id"), text_digest(docs[text_col]).alias("digest"), docs[text_col].cast("string").alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            prints = [fingerprint(t.lower().split(), shingle) for t in encoded(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(prints, np.uint64).view(np.int64))],
                names=["id", "digest", "print"],
            )

    return rows.mapInArrow(run, f"id {kind}, digest long, print long")


def linked_prints(prints: DataFrame, distance: int = DISTANCE, key_members: int = KEY_MEMBERS) -> DataFrame:
    """(a, b): a spanning set of the links between the distinct ``print`` values."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"the keys find distances up to {DISTANCE}")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = golay_tables()
        masks = [np.uint64(equal_bits(n << 34)).astype(np.int64) for n in range(len(arrangements()))]
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for number, (keys, own) in enumerate(golay_keys(values, tables)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(np.full(keys.size, masks[number])), pa.array(own.view(np.int64))],
                    names=["key", "mask", "print"],
                )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _links_of_keys(batches, distance, key_members)

    def refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _refined(batches, distance)

    schema = "key long, mask long, print long"
    rows = prints.select("print").distinct().mapInArrow(keyed, schema)
    links = None
    while True:
        dealt = rows.repartition("key").sortWithinPartitions("key", "print")
        found = written(dealt.mapInArrow(linked, "a long, b long, mask long, late boolean").distinct(), "links")
        now = found.filter("not late").select("a", "b")
        links = now if links is None else links.unionByName(now)
        late = found.filter("late").select(F.col("a").alias("key"), "mask", F.col("b").alias("print"))
        if late.isEmpty():  # each round fixes a fifth of the free bits, so this ends
            return links
        rows = late.mapInArrow(refined, schema)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = DISTANCE
) -> DataFrame:
    """One row per row of ``docs``: id, digest, print, root (the least
    fingerprint of the component) and component_id (its least id)."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "prints")
    nodes = connected_components(linked_prints(prints, distance))
    own = prints.groupBy("print").agg(F.min("id").alias("least"))
    rooted = own.join(nodes, own["print"] == nodes["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("print", "root").join(lowest, "root")
    return prints.join(named, "print").select("id", "digest", "print", "root", "component_id")


def hex_print(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = DISTANCE
) -> DataFrame:
    """One row of each component: that of the least id (a null id only if there
    is no other), and of repeated rows one. All columns stay."""
    found = written(near_duplicates(docs, id_col, text_col, shingle, distance), "components")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("digest")))
    best = found.groupBy("root").agg(first.alias("best")).select("best.id", "best.digest")
    copies = found.groupBy("id", "digest").agg(F.count("*").alias("n"))
    best = best.alias("b").join(
        copies.alias("c"), F.col("b.id").eqNullSafe(F.col("c.id")) & (F.col("b.digest") == F.col("c.digest"))
    ).select(F.col("b.id").alias("_id"), F.col("b.digest").alias("_d"), "n")
    best = written(best, "kept")
    marked = as_row(docs, F.col(id_col).alias("_own"), text_digest(F.col(text_col)).alias("_digest"))
    joined = marked.join(best, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_d")))
    once = joined.filter("n = 1").select(*row_columns(docs))
    repeated = joined.filter("n > 1").dropDuplicates(["_own", "_digest"]).select(*row_columns(docs))
    return once.unionByName(repeated)
