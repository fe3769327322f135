"""Cohort analytics: grouped profiles, shares, rates, banded and missing-data
profiles, top-k rows and groups, shared-key reports.

Every operator is one declarative DataFrame plan. Aggregations run as a
partial (map-side) + final HashAggregate pair, so a hot group costs one
pre-aggregated row per input partition, never a task holding its rows.
Grand totals are scalar subqueries over the already-aggregated rows (no
single-partition window, no cross join); totals within a key are a
second partial aggregation joined back on the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import ColumnOrName, _col, count_when, list_position, pct

Aggs = Mapping[str, Column]


def _named(aggs: Aggs) -> list[Column]:
    return [c.alias(name) for name, c in aggs.items()]


def _keys(by: Sequence[ColumnOrName] | ColumnOrName) -> list[Column]:
    if isinstance(by, (str, Column)):
        by = [by]
    return [_col(b) for b in by]


def overview(df: DataFrame, aggs: Aggs) -> DataFrame:
    """Global aggregate (one row): counts, distinct counts, rates, missing."""
    return df.agg(*_named(aggs))


def group_profile(
    df: DataFrame,
    by: Sequence[ColumnOrName] | ColumnOrName,
    aggs: Aggs,
    *,
    count_name: str | None = "row_count",
    having: Column | None = None,
    order_by: Sequence[ColumnOrName] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """``GROUP BY by`` with a row count and named aggregates.

    NULL keys form their own group (SQL semantics). ``having`` filters
    groups; ``order_by`` + ``limit`` compile to TakeOrderedAndProject.
    """
    cols = ([F.count(F.lit(1)).alias(count_name)] if count_name else []) + _named(aggs)
    out = df.groupBy(*_keys(by)).agg(*cols)
    if having is not None:
        out = out.filter(having)
    if order_by is not None:
        out = out.orderBy(*order_by)
    if limit is not None:
        out = out.limit(limit)
    return out


def share_of_total(
    df: DataFrame,
    by: Sequence[ColumnOrName] | ColumnOrName,
    *,
    count_name: str = "row_count",
    share_name: str = "share_percent",
    decimals: int = 2,
) -> DataFrame:
    """Count per group and its percentage of the grand total.

    The total is a scalar subquery over the grouped rows, so the base table
    is scanned once and no single-partition window is needed.
    """
    grouped = df.groupBy(*_keys(by)).agg(F.count(F.lit(1)).alias(count_name))
    total = grouped.agg(F.sum(count_name)).scalar()
    return grouped.withColumn(share_name, pct(F.col(count_name), total, decimals))


def _totals_join(grouped: DataFrame, keys: Sequence[str], count_name: str) -> DataFrame:
    """Attach ``_total`` = sum of ``count_name`` per ``keys`` (null-safe)."""
    totals = grouped.groupBy(*keys).agg(F.sum(count_name).alias("_total"))
    totals = totals.withColumnsRenamed({k: f"_t_{k}" for k in keys})
    cond = [grouped[k].eqNullSafe(totals[f"_t_{k}"]) for k in keys]
    return grouped.join(totals, cond).drop(*[f"_t_{k}" for k in keys])


def share_within(
    df: DataFrame,
    outer: ColumnOrName,
    inner: ColumnOrName,
    *,
    count_name: str = "row_count",
    share_name: str = "share_within_percent",
    decimals: int = 2,
    drop_null_outer: bool = True,
) -> DataFrame:
    """Count per (outer, inner) and its percentage within ``outer``.

    Totals per ``outer`` are a second (partial) aggregation of the grouped
    rows joined back on ``outer``: the totals table has one row per outer
    value, so AQE broadcasts it when small and a hot outer value is never
    gathered into one task (as a window partitioned by ``outer`` would).
    """
    outer_c, inner_c = _col(outer), _col(inner)
    src = df.filter(outer_c.isNotNull()) if drop_null_outer else df
    grouped = src.groupBy(outer_c, inner_c).agg(F.count(F.lit(1)).alias(count_name))
    joined = _totals_join(grouped, [grouped.columns[0]], count_name)
    return joined.withColumn(share_name, pct(F.col(count_name), F.col("_total"), decimals)).drop("_total")


def outcome_rate(
    df: DataFrame,
    by: Sequence[ColumnOrName] | ColumnOrName,
    outcome: ColumnOrName,
    *,
    count_name: str = "row_count",
    positive_name: str = "positive_count",
    negative_name: str = "negative_count",
    rate_name: str = "positive_rate_percent",
    decimals: int = 2,
) -> DataFrame:
    """Count, positives, negatives (count - positives) and rate of a 0/1."""
    y = _col(outcome)
    return (df.groupBy(*_keys(by))
            .agg(F.count(F.lit(1)).alias(count_name),
                 F.sum(y).cast("long").alias(positive_name),
                 (F.count(F.lit(1)) - F.sum(y)).cast("long").alias(negative_name),
                 F.round(F.lit(100.0) * F.avg(y.cast("double")), decimals).alias(rate_name)))


def numeric_stats(
    df: DataFrame,
    by: Sequence[ColumnOrName] | ColumnOrName,
    value: ColumnOrName,
    *,
    prefix: str = "value",
    decimals: int = 2,
) -> DataFrame:
    """Non-null count, min, mean, max and population variance of ``value``.

    Variance uses ``var_pop`` (Welford-style merge) rather than the
    ``E[x^2] - E[x]^2`` text formula, which loses precision at large means.
    """
    v = _col(value)
    return (df.groupBy(*_keys(by))
            .agg(F.count(v).alias(f"{prefix}_count"),
                 F.round(F.min(v), decimals).alias(f"{prefix}_min"),
                 F.round(F.avg(v), decimals).alias(f"{prefix}_avg"),
                 F.round(F.max(v), decimals).alias(f"{prefix}_max"),
                 F.round(F.var_pop(v), decimals).alias(f"{prefix}_variance")))


def banded_profile(
    df: DataFrame,
    by: Sequence[ColumnOrName] | ColumnOrName,
    value: ColumnOrName,
    bands: Sequence[tuple[str, float | None, float | None]],
    *,
    prefix: str = "value",
    decimals: int = 2,
) -> DataFrame:
    """Coverage, missing count, mean/min/max and counts per half-open band
    ``[lo, hi)`` (``None`` = unbounded). Null values fall in no band."""
    v = _col(value)
    band_cols = []
    for name, lo, hi in bands:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (v >= F.lit(lo))
        if hi is not None:
            cond = cond & (v < F.lit(hi))
        band_cols.append(count_when(cond).alias(name))
    return (df.groupBy(*_keys(by))
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.count(v).alias(f"{prefix}_known_count"),
                 count_when(v.isNull()).alias(f"{prefix}_missing_count"),
                 F.round(F.avg(v), decimals).alias(f"{prefix}_avg"),
                 F.round(F.min(v), decimals).alias(f"{prefix}_min"),
                 F.round(F.max(v), decimals).alias(f"{prefix}_max"),
                 *band_cols))


def order_by_list(
    df: DataFrame,
    column: str,
    order: Sequence[object],
    *then: ColumnOrName,
) -> DataFrame:
    """Sort by a fixed category order (unknown values last), then ``then``."""
    return df.orderBy(list_position(column, order), *then)


def top_k(
    df: DataFrame,
    order: Sequence[Column],
    k: int,
    *,
    not_null: Sequence[ColumnOrName] = (),
    columns: Sequence[ColumnOrName] | None = None,
) -> DataFrame:
    """First ``k`` rows by ``order`` (include a unique tie-break key).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: every partition
    keeps its own k best rows and only those reach the final merge.
    """
    out = df
    for c in not_null:
        out = out.filter(_col(c).isNotNull())
    if columns is not None:
        out = out.select(*[_col(c) for c in columns])
    return out.orderBy(*order).limit(k)


def missing_by_group(
    df: DataFrame,
    by: Sequence[ColumnOrName] | ColumnOrName,
    checks: Mapping[str, tuple[Column, bool]],
    *,
    count_name: str = "row_count",
    decimals: int = 2,
) -> DataFrame:
    """Per group: row count, and for each ``name -> (is_missing, with_pct)``
    a ``<name>_count`` and optionally ``<name>_percent`` of the group."""
    aggs = [F.count(F.lit(1)).alias(count_name)]
    for name, (cond, with_pct) in checks.items():
        aggs.append(count_when(cond).alias(f"{name}_count"))
        if with_pct:
            aggs.append(pct(count_when(cond), F.count(F.lit(1)), decimals).alias(f"{name}_percent"))
    return df.groupBy(*_keys(by)).agg(*aggs)


def shared_keys(
    df: DataFrame,
    key: ColumnOrName,
    category: ColumnOrName,
    value: ColumnOrName,
    *,
    key_name: str = "shared_key",
    k: int = 30,
    min_count: int = 2,
    decimals: int = 2,
) -> DataFrame:
    """Keys used by at least ``min_count`` rows, with the number of distinct
    categories, mean value and the sorted category list, top ``k`` by size.

    Only the top keys have their categories listed: these are gathered from the
    distinct (key, category) pairs of at most ``k`` keys, after the limit.
    """
    key_c, cat, val = _col(key), _col(category), _col(value)
    kept = df.filter(key_c.isNotNull() & (F.trim(key_c) != "")).select(
        key_c.alias(key_name), cat.alias("_category"), val.alias("_value"))
    grouped = kept.groupBy(key_name).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("_category").alias("distinct_categories"),
        F.round(F.avg("_value"), decimals).alias("average_value"))
    order = (F.col("row_count").desc(), F.col(key_name))
    top = grouped.filter(F.col("row_count") >= min_count).orderBy(*order).limit(k)
    listed = kept.join(F.broadcast(top.select(key_name)), key_name, "left_semi").select(key_name, "_category").distinct()
    listed = listed.groupBy(key_name).agg(
        F.array_join(F.array_sort(F.collect_set("_category")).cast("array<string>"), ",").alias("categories"))
    return top.join(listed, key_name, "left").orderBy(*order)


def profile_join(
    profile: DataFrame,
    base: DataFrame,
    key: str,
    base_key: ColumnOrName,
    aggs: Aggs,
) -> DataFrame:
    """Attach extra per-group aggregates of ``base`` to a grouped profile.

    Equivalent to joining the profile to every base row and re-grouping,
    but the base is aggregated first (partial + final), so the join sees one
    row per key on each side instead of the whole base table.
    """
    extra = base.groupBy(_col(base_key).alias(key)).agg(*_named(aggs))
    return profile.join(extra, on=key, how="inner")


def averages_through_join(
    fact: DataFrame,
    fact_key: str,
    dim: DataFrame,
    dim_key: str,
    group: str,
    averages: Mapping[str, tuple[Column, float, int]],
    *,
    group_name: str | None = None,
) -> DataFrame:
    """Per ``dim`` group, ``round(scale * avg(expr), decimals)`` over the
    fact rows that join to the dimension (inner join semantics).

    Averages decompose into sums and counts, so the facts are first
    aggregated per join key (partial + final aggregate) and only one row
    per key meets the dimension: a key holding a third of the facts costs
    one row in the join, and the join input shrinks from facts to keys."""
    group_name = group_name or group
    parts = []
    for i, (_, (expr, _, _)) in enumerate(averages.items()):
        parts += [F.sum(expr).alias(f"_s{i}"), F.count(expr).alias(f"_n{i}")]
    per_key = fact.groupBy(F.col(fact_key).alias("_k")).agg(*parts)
    joined = per_key.join(dim.select(F.col(dim_key).alias("_k"), F.col(group).alias(group_name)), "_k")
    return joined.groupBy(group_name).agg(*[
        F.round(F.lit(float(scale)) * F.try_divide(F.sum(f"_s{i}"), F.sum(f"_n{i}")), decimals).alias(name)
        for i, (name, (_, scale, decimals)) in enumerate(averages.items())])
