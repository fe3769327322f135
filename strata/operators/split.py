"""Exact stratified train/test split and stratified k-fold assignment.

Rows are ordered within their class by a seeded hash of the id (ties: the
id); the first ``quota`` rows of each class form the test set, and folds are
consecutive blocks. Nothing is sampled and no row is moved: the hash's high
bits are buckets, one count per (class, bucket) tells which bucket holds a
cut, only the narrow (hash, id) pairs of those buckets are ranked, and each
cut becomes a (hash, id) bound that every row is compared with in one narrow
pass. The counts are local rows while they are few (some two dozen classes) and
a table of the cluster beyond; there may be any number of classes. The result
depends on the rows alone, not on how they are partitioned.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.quantiles import local_rows, per_group
from strata.operators.rows import with_row_number
from strata.session import cut_lineage

# Buckets of a class: 2 ** BUCKET_BITS; a bucket holds that fraction of a class's rows.
BUCKET_BITS = 12
MAX_CLASSES = 10_000  # of a label that a model is to be fitted to


def seeded_hash(seed: int, *cols: Column | str) -> Column:
    """Deterministic pseudo-random order key."""
    return F.xxhash64(F.lit(seed), *cols)


def _bucket(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits)


def hash_rank(df: DataFrame, group: str | Sequence[str], key: Column, ties: Sequence[Column | str],
              name: str = "rank", *, bits: int = BUCKET_BITS) -> DataFrame:
    """0-based exact rank of each row within ``group`` by the 64-bit hash
    ``key`` (as unsigned number) and then ``ties``.

    Rows are numbered inside (group, bucket) windows, a bucket being the
    hash's high ``bits``, and the rows of the buckets before are added from
    one count per (group, bucket). A group of any size spreads over 2**bits
    windows, and both sides are functions of the row alone."""
    groups = [group] if isinstance(group, str) else list(group)
    gcols = [F.col(g) for g in groups]
    keyed = df.withColumn("_key", key).withColumn("_bucket", _bucket(F.col("_key"), bits))
    before = Window.partitionBy(*gcols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy(*gcols, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select(F.col("_bucket").alias("_m_bucket"), *[F.col(g).alias(f"_m_{g}") for g in groups],
                             F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # unsigned order inside a bucket: its rows share the high bits, so signed order is the same
    inside = Window.partitionBy(*gcols, "_bucket").orderBy("_key", *ties)
    ranked = keyed.withColumn("_pos", F.row_number().over(inside) - 1)
    cond = [F.col("_bucket") == F.col("_m_bucket")] + [F.col(g).eqNullSafe(F.col(f"_m_{g}")) for g in groups]
    out = ranked.join(offsets, cond).withColumn(name, (F.col("_off") + F.col("_pos")).cast("long"))
    return out.drop("_key", "_bucket", "_pos", "_off", "_m_bucket", *[f"_m_{g}" for g in groups])


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class (one row per class reaches the driver; a column with
    more than ``MAX_CLASSES`` values is no class label and is refused)."""
    rows = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"column '{label}' has more than {MAX_CLASSES} distinct values")
    return {r[0]: r[1] for r in rows}


class _HoldoutCuts:
    """One cut a class: behind its test rows."""

    def __init__(self, test_fraction: float):
        self.test_fraction = test_fraction

    def local(self, counts: dict) -> dict:
        return {c: [q] for c, q in holdout_quotas(counts, self.test_fraction).items()}

    def table(self, totals: DataFrame) -> DataFrame:
        """(_label, _cuts) from (_label, _n), as ``holdout_quotas`` has it."""
        n = totals.agg(F.sum("_n")).first()[0]
        n_test = math.ceil(self.test_fraction * n)
        shared = totals.withColumn("_exact", F.expr(f"double({n_test}L * _n) / {n}L"))
        shared = shared.withColumns({"_quota": F.floor("_exact"), "_rest": F.col("_exact") - F.floor("_exact")})
        left = n_test - (shared.agg(F.sum("_quota")).first()[0] or 0)
        ranked = with_row_number(shared.orderBy(F.desc("_rest"), "_label"), "_rank")
        return ranked.select("_label", F.array(F.col("_quota") + (F.col("_rank") <= left).cast("long")).alias("_cuts"))


class _FoldCuts:
    """k - 1 cuts a class, between blocks whose sizes differ by one at most."""

    def __init__(self, k: int):
        self.k = k

    def local(self, counts: dict) -> dict:
        if min(counts.values(), default=self.k) < self.k:
            raise ValueError(f"every class needs at least {self.k} rows for {self.k}-fold CV: {counts}")
        return {c: list(accumulate(n // self.k + (i < n % self.k) for i in range(self.k - 1))) for c, n in counts.items()}

    def table(self, totals: DataFrame) -> DataFrame:
        small = totals.filter(F.col("_n") < self.k).limit(10).collect()
        if small:
            raise ValueError(f"every class needs at least {self.k} rows for {self.k}-fold CV: {dict(map(tuple, small))}")
        return totals.selectExpr("_label", f"transform(sequence(1, {self.k - 1}), i -> i * (_n div {self.k}) + least(i, _n % {self.k})) AS _cuts")


def _wanted(narrow: DataFrame, cuts: _HoldoutCuts | _FoldCuts) -> DataFrame:
    """(_w_label, _w_bucket, _w_pos): the bucket that holds each cut, and its rank in there."""
    spark, counts = narrow.sparkSession, narrow.groupBy("_label", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    rows = local_rows(counts)
    kind = narrow.schema["_label"].dataType.simpleString()
    if rows is not None:
        by_class: dict = {}
        for r in rows.to_pylist():
            by_class.setdefault(r["_label"], []).append((r["_bucket"], r["_n"]))
        totals = {c: sum(n for _, n in found) for c, found in by_class.items()}
        wanted = []
        for c, ranks in cuts.local(totals).items():
            found = sorted(by_class[c])
            before = [0, *accumulate(n for _, n in found)]
            wanted += [(c, found[at][0], rank - before[at]) for rank in ranks if rank < before[-1]
                       for at in (bisect_right(before, rank) - 1,)]
        return F.broadcast(spark.createDataFrame(wanted, f"_w_label {kind}, _w_bucket long, _w_pos long"))
    counts = cut_lineage(counts)
    upto = Window.partitionBy("_label").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    ranks = cuts.table(counts.groupBy("_label").agg(F.sum("_n").alias("_n"))).select(
        F.col("_label").alias("_w_label"), F.explode("_cuts").alias("_rank"))
    held = counts.join(ranks, F.col("_label").eqNullSafe(F.col("_w_label")) & (F.col("_rank") >= F.col("_before"))
                       & (F.col("_rank") < F.col("_before") + F.col("_n")))
    return held.select("_w_label", F.col("_bucket").alias("_w_bucket"), (F.col("_rank") - F.col("_before")).alias("_w_pos"))


def _cut_bounds(df: DataFrame, label: str, id_col: str, key: Column, cuts: _HoldoutCuts | _FoldCuts) -> DataFrame:
    """(_label, _bounds): for each class the rows (bucket, hash, id) at its
    cuts' 0-based ranks; a rank past the class's end has none."""
    narrow = df.select(F.col(label).alias("_label"), key.alias("_key"), F.col(id_col).alias("_id"))
    narrow = narrow.withColumn("_bucket", _bucket(F.col("_key"), BUCKET_BITS))
    wanted = _wanted(narrow, cuts)
    same = F.col("_label").eqNullSafe(F.col("_w_label")) & (F.col("_bucket") == F.col("_w_bucket"))
    inside = Window.partitionBy("_label", "_bucket").orderBy("_key", "_id")
    # only rows of a bucket that holds a cut are moved and ranked
    held = narrow.join(wanted, same, "left_semi").withColumn("_pos", F.row_number().over(inside) - 1)
    cut_rows = held.join(wanted, same & (F.col("_pos") == F.col("_w_pos")))
    place = F.struct(F.col("_bucket").alias("b"), F.col("_key").alias("k"), F.col("_id").alias("i"))
    return cut_rows.groupBy("_label").agg(F.collect_list(place).alias("_bounds"))


def _cuts_passed(df: DataFrame, label: str, id_col: str, key: Column, cuts: _HoldoutCuts | _FoldCuts, name: str) -> DataFrame:
    """Add ``name``: at or behind how many of its class's cut rows a row lies,
    in (hash, id) order. Ids must be unique: rows that repeat one tie."""
    bounds = per_group(_cut_bounds(df, label, id_col, key, cuts))  # one row for each class
    # the bucket first, so that the hash counts as an unsigned number
    own = F.struct(_bucket(key, BUCKET_BITS).alias("b"), key.alias("k"), F.col(id_col).alias("i"))
    joined = df.withColumn("_own", own).join(bounds, F.col(label).eqNullSafe(F.col("_label")), "left")
    passed = F.size(F.filter("_bounds", lambda x: x <= F.col("_own")))
    return joined.withColumn(name, F.when(F.col("_bounds").isNull(), 0).otherwise(passed)).drop("_own", "_label", "_bounds")


def holdout_quotas(counts: dict, test_fraction: float) -> dict:
    """Test rows per class: ``ceil(fraction * n)`` in total, shared in
    proportion to class size, leftover rows to the largest remainders
    (ties -> smaller class label)."""
    n = sum(counts.values())
    n_test = math.ceil(test_fraction * n)
    exact = {c: n_test * k / n for c, k in counts.items()}
    quota = {c: math.floor(v) for c, v in exact.items()}
    left = n_test - sum(quota.values())
    for c in sorted(counts, key=lambda c: (-(exact[c] - quota[c]), c is not None, c))[:left]:
        quota[c] += 1
    return quota


def _lookup(mapping: dict, key: Column, cast: str = "long") -> Column:
    from itertools import chain
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return m[key].cast(cast)


def stratified_split(
    df: DataFrame,
    label: str,
    id_col: str,
    test_fraction: float = 0.2,
    seed: int = 42,
    split_col: str = "is_test",
    exact: bool = True,
) -> DataFrame:
    """Add a boolean ``split_col``: exact per-class test quotas, rows picked
    by seeded hash order (deterministic, independent of partitioning).

    ``exact=False`` skips the counting and the sort: each row is a test row
    when its seeded hash falls below ``test_fraction`` (one narrow pass, no
    shuffle; per-class shares hold in expectation, not exactly)."""
    if not exact:
        u = F.pmod(seeded_hash(seed, id_col), F.lit(1_000_000)) / 1_000_000.0
        return df.withColumn(split_col, u < F.lit(test_fraction))
    passed = _cuts_passed(df, label, id_col, seeded_hash(seed, id_col), _HoldoutCuts(test_fraction), "_passed")
    return passed.withColumn(split_col, F.col("_passed") == 0).drop("_passed")


def stratified_folds(
    df: DataFrame,
    label: str,
    id_col: str,
    k: int = 5,
    seed: int = 42,
    fold_col: str = "fold",
    exact: bool = True,
) -> DataFrame:
    """Add ``fold_col`` in 0..k-1: each class is cut into k blocks of sizes
    differing by at most one (larger blocks first), by seeded hash order.
    ``exact=False`` uses ``pmod(hash, k)`` instead (no shuffle; balanced in
    expectation)."""
    if not exact:
        return df.withColumn(fold_col, F.pmod(seeded_hash(seed + 1, id_col), F.lit(k)).cast("int"))
    return _cuts_passed(df, label, id_col, seeded_hash(seed + 1, id_col), _FoldCuts(k), fold_col)


def class_weights(counts: dict) -> dict:
    """Balanced weights n / (k * n_c)."""
    n, k = sum(counts.values()), len(counts)
    return {c: n / (k * m) for c, m in counts.items()}


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight", counts: dict | None = None) -> DataFrame:
    counts = counts or class_counts(df, label)
    return df.withColumn(weight_col, _lookup(class_weights(counts), F.col(label), "double"))
