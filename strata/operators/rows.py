"""Consecutive 1-based row numbers in file order without a global window.

``row_number() OVER ()`` would pull every row into one task. Here each row is
known by its scan partition and its position in it, and each file split by its
file, its start in the file and the first of its positions. Splits (a small
table, one row for each) are put in the order in which the files would be read
one after another, with the rows before each as a prefix sum; a partition's
splits are broadcast back to its rows, which look up their own by position.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_POS_BITS = 33


def _has_exchange(df: DataFrame) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "Exchange" in plan


def _with_split(df: DataFrame) -> DataFrame:
    """``df`` with ``_file`` and ``_block``: the file that a row was read from and
    where in it its split starts; nulls where the rows come from no file scan."""
    try:
        meta = df.metadataColumn("_metadata")
        tagged = df.withColumns({"_file": meta["file_path"], "_block": meta["file_block_start"]})
        tagged.schema  # resolves the columns, or raises
        return tagged
    except AnalysisException:
        return df.withColumns({"_file": F.lit(None).cast("string"), "_block": F.lit(None).cast("long")})


def with_row_number(df: DataFrame, name: str = "row_number") -> DataFrame:
    """Append ``name``: 1..n in file order: by file path, then by place in the
    file, whatever the sizes of the files and however they are split over tasks.
    Rows that come from no file scan are numbered in partition order.

    ``df`` is read twice (splits, then numbering), so its partitions must be
    reproducible: a file scan with narrow transformations is. If the plan
    contains a shuffle (whose partitions AQE may coalesce differently per
    read), the input is first materialized with ``checkpoint()`` in the shared
    checkpoint folder and numbered in its partition order.
    """
    if _has_exchange(df):
        from strata.session import cut_lineage
        df = cut_lineage(df)
    tagged = _with_split(df).withColumns({
        "_pid": F.spark_partition_id(),
        "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POS_BITS) - 1))})
    splits = tagged.groupBy("_pid", "_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    # one row per file split: the running sum is over a table of the size of a file listing
    in_order = Window.orderBy("_file", "_block", "_pid").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(in_order), F.lit(0)) - F.col("_first")
    splits = splits.select("_pid", F.struct("_first", before.alias("_off")).alias("_split"))
    # 16 bytes a split: a hundred terabytes of 128 MB splits make about 13 MB
    by_task = splits.groupBy("_pid").agg(F.collect_list("_split").alias("_splits"))
    own = F.array_max(F.filter("_splits", lambda s: s["_first"] <= F.col("_pos")))
    numbered = tagged.join(F.broadcast(by_task), "_pid")
    return numbered.withColumn(name, (own["_off"] + F.col("_pos") + 1).cast("long")).drop(
        "_pid", "_pos", "_file", "_block", "_splits")
