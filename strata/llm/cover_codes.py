"""Product codes of vectors, their codebooks fitted by Lloyd rounds over cover trees.

A vector is cut into equal consecutive parts; each part position has a codebook
of its own, and a vector's code is the nearest entry of each part (squared
Euclidean distance over integers, ties to the lower index).

1. Each partition cuts its vectors into tiles and builds one cover tree a part:
   centres are taken farthest first, so the centres down to a level cover the
   tile within that level's radius, half of the level's above, and stand
   farther apart than it. A tile's points lie in the order of a walk through
   the tree: a subtree is a range of points. The trees are written once and
   serve every round.
2. A round walks all trees with the codebook. An entry that the triangle
   inequality rules out for every point of a subtree goes no further down; a
   subtree with one entry left is assigned whole, its count and sum taken from
   cumulative sums. Points of leaves that stay ambiguous are compared exactly
   with the entries left. Each task sends one count and sum per entry.
3. After the last round the same walk, with exact distances, gives the codes.

The driver holds the codebooks only (parts x entries x part length numbers).
Sums are exact, so results do not depend on tiles or partitions.

A vector that is null or holds a null or non-finite component is dropped. One
whose length is not the commonest (among multiples of ``parts``; ties: the
longest), or with a component too large for exact 64-bit distances (see
``largest``), keeps its row with a null code and error and has no part in the
codebooks. Null ids are coded but start no codebook; repeated rows are coded
each, and count each; with fewer coded vectors than ``entries`` the codebooks
are that much shorter; an empty table gives no rows. All other columns, of any
name, come back in one struct.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import ROW, ship_by_value, written

ship_by_value(__name__)

SCALE = 256  # components become floor(SCALE * x)
TILE = 2048  # vectors for which one set of trees is built
CELLS = 256  # centres of a tree; each owns a leaf of about TILE / CELLS points
TREE = T.StructType([T.StructField(c, T.BinaryType()) for c in ("order", "nodes", "kids", "radius")])


def largest(length: int, entries: int) -> int:
    """Components up to this size keep (distance * entries + entry) within 63 bits."""
    return math.isqrt((1 << 62) // max(1, length * entries)) // 2


@dataclass
class Tree:
    """``order``: the points in walk order. Node k covers the places ``lo[k]`` to
    ``hi[k]`` of it and has its centre at ``lo[k]``; its children are
    ``kids[first[k] : first[k] + many[k]]`` (none: a leaf); no point is farther
    than ``radius[k]`` from the centre. The last node is the root."""

    order: np.ndarray
    nodes: np.ndarray
    kids: np.ndarray
    radius: np.ndarray

    def packed(self) -> dict:
        return {"order": self.order.astype(np.int32).tobytes(), "nodes": self.nodes.astype(np.int32).tobytes(),
                "kids": self.kids.astype(np.int32).tobytes(), "radius": self.radius.tobytes()}

    @staticmethod
    def unpacked(x: dict) -> Tree:
        return Tree(np.frombuffer(x["order"], np.int32), np.frombuffer(x["nodes"], np.int32).reshape(4, -1),
                    np.frombuffer(x["kids"], np.int32), np.frombuffer(x["radius"], np.float64))


def cover_tree(points: np.ndarray, cells: int = CELLS) -> Tree:
    """Cover tree of the rows of ``points``, its centres taken farthest first."""
    columns = np.ascontiguousarray(points.T, dtype=np.float64)

    def away(i: int) -> np.ndarray:
        x = columns - columns[:, i : i + 1]
        return np.einsum("ij,ij->j", x, x)

    n = len(points)
    gap, owner = away(0), np.zeros(n, np.int64)
    centres, parents, levels = [0], [-1], [0]
    widest, level, above = gap.max(), 1, owner.copy()
    while len(centres) < min(cells, n):
        x = int(gap.argmax())
        if gap[x] == 0:
            break
        if gap[x] * 4.0**level <= widest:  # this level covers all: its centres become parents
            above = owner.copy()
            while gap[x] * 4.0**level <= widest:
                level += 1
        new = away(x)
        closer = new < gap
        gap[closer] = new[closer]
        owner[closer] = len(centres)
        centres.append(x)
        parents.append(int(above[x]))
        levels.append(level)
    m = len(centres)
    own = np.bincount(owner, minlength=m)
    by_owner = np.argsort(owner, kind="stable")
    bucket_at = np.cumsum(own) - own
    size, kids_of = own.copy(), [[] for _ in range(m)]
    for j in range(m - 1, 0, -1):
        size[parents[j]] += size[j]
        kids_of[parents[j]].append(j)  # finest first
    order, start, stack, at = np.empty(n, np.int64), np.zeros(m, np.int64), [0], 0
    while stack:
        j = stack.pop()
        bucket = by_owner[bucket_at[j] : bucket_at[j] + own[j]]
        start[j] = at
        order[at : at + own[j]] = np.concatenate(([centres[j]], bucket[bucket != centres[j]]))
        at += own[j]
        stack.extend(reversed(kids_of[j]))  # the finest lies next to its parent's bucket
    lo, hi, first, many, kids, radius = [], [], [], [], [], []
    top = [0] * m
    laid = columns[:, order]
    for j in range(m - 1, -1, -1):
        a, b = int(start[j]), int(start[j] + own[j])
        x = laid[:, a : a + size[j]] - laid[:, a : a + 1]
        reach = np.sqrt(np.maximum.accumulate(np.einsum("ij,ij->j", x, x))) * (1 + 1e-9)

        def node(children: list[int], b: int) -> None:
            lo.append(a)
            hi.append(b)
            first.append(len(kids))
            many.append(len(children))
            kids.extend(children)
            radius.append(float(reach[b - a - 1]))

        node([], b)
        k = 0
        while k < len(kids_of[j]):
            group = [c for c in kids_of[j][k:] if levels[c] == levels[kids_of[j][k]]]
            children = [len(lo) - 1, *[top[c] for c in group]]
            b += sum(int(size[c]) for c in group)
            node(children, b)
            k += len(group)
        top[j] = len(lo) - 1
    return Tree(order, np.array([lo, hi, first, many]), np.array(kids, np.int64), np.array(radius))


def walk(tree: Tree, points: np.ndarray, book: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...], int]:
    """Assign the points of a tree, given in its order, to the entries of ``book``.

    Returns the subtrees assigned whole (from, to, entry), the single points
    (place, entry), and how many exact comparisons the points took."""
    lo, hi, first, many = tree.nodes
    k = len(book)
    at, left = np.array([lo.size - 1]), np.ones((1, k), bool)
    whole, single, compared = [], [], 0
    none = np.zeros(0, np.int64)
    while at.size:
        apart = points[lo[at]][:, None, :] - book[None]
        gap = np.sqrt(np.einsum("nkd,nkd->nk", apart, apart).astype(np.float64))
        gap[~left] = np.inf
        near = gap.min(1, keepdims=True)
        # an entry farther from the centre than the nearest one by over two radii is farther from every point
        left &= gap <= (near + 2 * tree.radius[at][:, None]) * (1 + 1e-9) + 1e-9
        sole = left.sum(1) == 1
        whole.append((lo[at[sole]], hi[at[sole]], left[sole].argmax(1)))
        at, left = at[~sole], left[~sole]
        leaf = many[at] == 0
        if leaf.any():
            spans, row = hi[at[leaf]] - lo[at[leaf]], np.nonzero(leaf)[0]
            place = np.repeat(lo[at[leaf]] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
            which, entry = np.nonzero(left[np.repeat(row, spans)])
            apart = points[place[which]] - book[entry]
            key = np.einsum("nd,nd->n", apart, apart) * k + entry  # the lower index wins a tie
            begin = np.searchsorted(which, np.arange(place.size))
            single.append((place, np.minimum.reduceat(key, begin) % k))
            compared += which.size
        at, left = at[~leaf], left[~leaf]
        n = many[at]
        child = np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        left = np.repeat(left, n, axis=0)
        at = tree.kids[child].astype(np.int64)
    join = lambda parts, width: tuple(np.concatenate(c) for c in zip(*parts)) if parts else (none,) * width
    return join(whole, 3), join(single, 2), compared


def _tiles(batches: Iterator[pa.RecordBatch], length: int, parts: int) -> Iterator[pa.RecordBatch]:
    """(row, vector) -> (rows, points, trees), one row for each tile."""

    def tile(rows: pa.Array, points: np.ndarray) -> pa.RecordBatch:
        width = length // parts
        trees = [cover_tree(points[:, p * width : (p + 1) * width]).packed() for p in range(parts)]
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
             pa.array([points.astype(np.int32).tobytes()], pa.binary()),
             pa.array([trees], pa.list_(pa.struct([(f.name, pa.binary()) for f in TREE])))],
            names=["rows", "points", "trees"],
        )

    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            taken = batch.slice(0, TILE - n)
            batch = batch.slice(taken.num_rows)
            flat = taken.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
            held.append((taken.column(0), np.floor(flat * SCALE).astype(np.int64)))
            n += taken.num_rows
            if n == TILE:
                yield tile(pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                held, n = [], 0
    if n:
        yield tile(pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held]))


def _each_part(batch: pa.RecordBatch, books: list[np.ndarray]):
    """For each tile of a batch: its number, and (part, tree, points in tree order) of each part."""
    parts, width = len(books), books[0].shape[1]
    for i in range(batch.num_rows):
        points = np.frombuffer(batch.column("points")[i].as_py(), np.int32).astype(np.int64).reshape(-1, parts * width)
        trees = [Tree.unpacked(x) for x in batch.column("trees")[i].as_py()]
        yield i, points, [(p, t, points[t.order, p * width : (p + 1) * width]) for p, t in enumerate(trees)]


def _sums(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Counts and sums of each entry over all tiles of a task."""
    parts, (k, width) = len(books), books[0].shape
    count, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
    for batch in batches:
        for _, _, each in _each_part(batch, books):
            for p, tree, points in each:
                (a, b, entry), (place, one), _ = walk(tree, points, books[p])
                running = np.concatenate((np.zeros((1, width), np.int64), points.cumsum(0)))
                np.add.at(count[p], entry, b - a)
                np.add.at(total[p], entry, running[b] - running[a])
                np.add.at(count[p], one, 1)
                np.add.at(total[p], one, points[place])
    part, entry = np.nonzero(count)
    if part.size:
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
             pa.array(list(total[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"],
        )


def _codes(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    parts = len(books)
    for batch in batches:
        for i, vectors, each in _each_part(batch, books):
            code, error = np.zeros((len(vectors), parts), np.uint8), np.zeros(len(vectors), np.int64)
            for p, tree, points in each:
                (a, b, entry), (place, one), _ = walk(tree, points, books[p])
                found = np.zeros(len(points), np.int64)
                found[place] = one
                spans = b - a
                found[np.repeat(a - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())] = np.repeat(entry, spans)
                apart = points - books[p][found]
                code[tree.order, p] = found
                error[tree.order] += np.einsum("nd,nd->n", apart, apart)
            text = code.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [batch.column("rows").slice(i, 1).flatten(),
                 pa.array([text[j : j + 2 * parts] for j in range(0, len(text), 2 * parts)]), pa.array(error)],
                names=[ROW, "code", "error"],
            )


def vector_codes(
    df: DataFrame, id_col: str, vector_col: str, parts: int = 16, entries: int = 64, rounds: int = 2
) -> tuple[DataFrame, list[list[list[int]]]]:
    """((row struct without the vector, ``code``, ``error``), codebooks by part and entry).

    ``code`` has two hex digits for each part (so at most 256 ``entries``),
    ``error`` is the squared distance over all parts. Codebooks start as the
    parts of the vectors with the ``entries`` smallest ids (rows of equal id by
    their vectors); entries that no part is nearest to stay as they are.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits for a part: at most 256 entries")
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns if c != vector_col]).alias(ROW), vector.alias("vector")
    ).filter(F.col("vector").isNotNull() & ~odd)
    long = kept.groupBy(F.size("vector").alias("n")).count().filter((F.col("n") > 0) & (F.col("n") % parts == 0))
    length = long.orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    length = length[0].n if length else parts
    most = largest(length // parts, entries) / SCALE
    fits = (F.size("vector") == length) & (F.array_max("vector") < most) & (F.array_min("vector") > -most)
    row_type = kept.schema[ROW].dataType
    schema = T.StructType([T.StructField("rows", T.ArrayType(row_type)), T.StructField("points", T.BinaryType()),
                           T.StructField("trees", T.ArrayType(TREE))])
    coded = kept.filter(fits)
    seeds = coded.select(F.col(ROW)[id_col].alias("id"), "vector").filter("id is not null").orderBy("id", "vector")
    seeds = np.array([r.vector for r in seeds.limit(entries).collect()], np.float64).reshape(-1, length)
    seeds = np.floor(seeds * SCALE).astype(np.int64)
    books = np.split(seeds, parts, axis=1)
    rest = kept.filter(~fits).select(ROW, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if not len(seeds):
        blank = kept.filter(fits).select(ROW, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return rest.union(blank), [[] for _ in range(parts)]
    tiles = written(coded.mapInArrow(partial(_tiles, length=length, parts=parts), schema), "cover-trees")
    for _ in range(rounds):
        sums = tiles.mapInArrow(partial(_sums, books=books), "part int, entry int, n long, total array<long>")
        new = [F.sum(F.col("total")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(length // parts)]
        books = [b.copy() for b in books]
        # one row for each entry of each part, whatever the input
        for part, entry, n, *total in sums.groupBy("part", "entry").agg(F.sum("n"), *new).collect():
            books[part][entry] = [int(t) // n for t in total]
    out = T.StructType([T.StructField(ROW, row_type), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    codes = tiles.mapInArrow(partial(_codes, books=books), out)
    return codes.unionByName(rest), [b.tolist() for b in books]
