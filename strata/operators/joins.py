"""Join helpers with explicit cardinality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise when a key occurs more than once (first 10 offenders shown)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(10).collect()
    if dup:
        raise ValueError(f"{what} has duplicate keys {list(keys)}: {[tuple(r)[:-1] for r in dup]}")


def left_join_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join validated one-to-one: both sides must be unique on the
    keys, so the join can never multiply rows. One aggregate over the keys of
    both sides checks them, before the join."""
    sides = [side.select(*keys, F.lit(i).alias("_side")) for i, side in enumerate((left, right))]
    counts = [F.count_if(F.col("_side") == i).alias(f"_n{i}") for i in (0, 1)]
    both = sides[0].unionByName(sides[1]).groupBy(*keys).agg(*counts).filter("_n0 > 1 OR _n1 > 1")
    found = both.limit(10).collect()
    for i, what in enumerate(("left side", "right side")):
        dup = [tuple(r)[: len(keys)] for r in found if r[f"_n{i}"] > 1]
        if dup:
            raise ValueError(f"{what} has duplicate keys {list(keys)}: {dup}")
    return left.join(right, list(keys), "left")
