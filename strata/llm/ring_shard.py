"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every row has a position on the ring from a hash of its key. Keys are taken in
ring order: a key goes to the shard of the next virtual node clockwise that is
not full; a full shard's keys continue clockwise. Since all keys of an arc
between two virtual nodes walk the same way, the ring can be filled arc by arc
from counts alone: the driver sees one count per cell of an arc (at most
``MAX_CELLS`` cells, or one for each virtual node), and rows find their shard
from their rank in the arc. No row passes the driver.

With ``slack`` 0 the capacities add up to the row count, so shard sizes differ
by one at most; a larger slack lets keys stay nearer their first choice.
Null keys hash like any value; repeated rows keep one ring position and are
told apart only by their rank; an empty table gives no rows. Rows are grouped
whole, so a map-typed column must be left out and joined on later.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ROW

RING = 1 << 62
ROWS_PER_CELL = 200_000
MAX_CELLS = 1 << 16


def virtual_nodes(shards: int, per_shard: int) -> list[tuple[int, int]]:
    """(position, shard), sorted. A shard's nodes do not depend on how many shards there are."""
    nodes = {}
    for shard in range(shards):
        for i in range(per_shard):
            nodes.setdefault(xxhash.xxh64_intdigest(f"{shard}/{i}") % RING, shard)
    return sorted(nodes.items())


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows that each shard may hold: at slack 0 they add up to ``rows``."""
    if slack:
        return [-(-int(rows * (1 + slack)) // shards) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def fill_ring(arc_rows: Sequence[int], owners: Sequence[int], room: Sequence[int]) -> list[list[tuple[int, int]]]:
    """For each arc, in ring order, the (shard, rows) that its keys go to."""
    left, n = list(room), len(owners)
    out = []
    for arc, rows in enumerate(arc_rows):
        parts: list[tuple[int, int]] = []
        at = arc
        while rows:
            shard = owners[at % n]
            take = min(rows, left[shard])
            if take:
                left[shard] -= take
                rows -= take
                parts.append((shard, take))
            at += 1
        out.append(parts)
    return out


def ring_shards(
    df: DataFrame, key_cols: Sequence[str], shards: int = 8, per_shard: int = 128, slack: float = 0.0,
    shard_col: str = "shard", slot_col: str = "slot",
) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    ``key_cols`` give the ring position. The rows of an arc are ranked in cells
    by a hash of the whole row, so rows that share a key spread over cells and
    the result does not depend on how the input is partitioned; equal rows are
    counted before they are shuffled and ranked together. Wide columns should
    be joined on later: all columns of ``df`` are shuffled. Columns that have the
    names of the two new ones are replaced.
    """
    spark = df.sparkSession
    nodes = virtual_nodes(shards, per_shard)
    ends, owners = [p for p, _ in nodes], [s for _, s in nodes]
    kept = [c for c in df.columns if c.lower() not in (shard_col.lower(), slot_col.lower())]
    columns = [F.col(ROW)]
    # Lookup of a position's arc: for each even cut of the ring, the nodes before it and inside it.
    cuts = 4 * len(nodes)
    width = RING // cuts
    table = [
        (c, first := bisect.bisect_left(ends, c * width), ends[first : bisect.bisect_left(ends, (c + 1) * width)])
        for c in range(cuts)
    ]
    table.append((cuts, len(ends), []))  # the few positions past the last even cut
    lookup = F.broadcast(spark.createDataFrame(table, "_cut int, _first int, _inside array<long>"))
    placed = (
        df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias(ROW))
        .groupBy(ROW).agg(F.count("*").alias("_copies"))
        .withColumn("_pos", F.xxhash64(*[F.col(ROW)[c] for c in key_cols]).bitwiseAND(F.lit(RING - 1)))
        .withColumn("_cut", F.expr(f"cast(_pos div {width} as int)"))
        .join(lookup, "_cut")
        # the arc past the last node wraps round to the first node
        .withColumn("_arc", (F.col("_first") + F.size(F.filter("_inside", lambda p: p < F.col("_pos")))) % len(ends))
        .drop("_cut", "_first", "_inside", "_pos")
    )
    total = df.count()
    subs = min(max(1, MAX_CELLS // len(nodes)), 1 + total // (len(nodes) * ROWS_PER_CELL))
    placed = placed.withColumn("_sub", F.pmod(F.xxhash64(*columns, F.lit("cell")), F.lit(subs)).cast("int"))
    # One row for each cell: bounded by MAX_CELLS and the virtual nodes, whatever the input.
    counted = sorted(map(tuple, placed.groupBy("_arc", "_sub").agg(F.sum("_copies")).collect()))
    arc_rows = [0] * len(nodes)
    before = []
    for arc, sub, n in counted:
        before.append((arc, sub, arc_rows[arc]))
        arc_rows[arc] += n
    used = [0] * shards
    segments = []
    for arc, parts in enumerate(fill_ring(arc_rows, owners, capacities(total, shards, slack))):
        start, found = 0, []
        for shard, n in parts:
            found.append((start, start + n, shard, used[shard]))
            used[shard] += n
            start += n
        segments.append((arc, found))
    cells = F.broadcast(spark.createDataFrame(before, "_arc int, _sub int, _before long"))
    arcs = F.broadcast(
        spark.createDataFrame(segments, "_arc int, _parts array<struct<a:long,b:long,shard:int,base:long>>")
    )
    in_cell = Window.partitionBy("_arc", "_sub").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        placed.withColumn("_n", F.coalesce(F.sum("_copies").over(in_cell), F.lit(0)))
        .join(cells, ["_arc", "_sub"]).join(arcs, "_arc")
        .withColumn("_n", F.col("_n") + F.col("_before"))
        # copies of a row take consecutive ranks; chunks keep the arrays small
        .withColumn("_from", F.explode(F.expr("sequence(0L, _copies - 1, 65536L)")))
        .withColumn("_n", F.explode(F.expr("transform(sequence(_from, least(_from + 65535, _copies - 1)), i -> i + _n)")))
        .withColumn("_part", F.filter("_parts", lambda p: (p["a"] <= F.col("_n")) & (F.col("_n") < p["b"]))[0])
    )
    return ranked.select(
        *[F.col(ROW)[c].alias(c) for c in kept], F.col("_part.shard").alias(shard_col),
        (F.col("_part.base") + F.col("_n") - F.col("_part.a")).alias(slot_col),
    )
