"""Distribution profiles: value counts, modes, crosstabs, describe tables,
grouped numeric summaries, histograms, box statistics and band counts.

pandas-style semantics (nulls dropped, sample std, linear-interpolated
percentiles). Moments come from single-pass aggregations; exact
percentiles from ``strata.operators.quantiles`` (counts of cells, no sort of
values and no per-group value buffers). Pass ``accuracy`` to use ``percentile_approx``.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from strata.functions.exprs import ColumnOrName, _col, bin_column, pct
from strata.operators.cohort import _totals_join
from strata.operators.quantiles import per_group, quantile_arrays, quantiles_long, quantiles_wide

PERCENTILES = (0.25, 0.5, 0.75)


def _pname(p: float) -> str:
    return f"p{round(p * 100):d}"


def value_counts(
    df: DataFrame,
    column: ColumnOrName,
    *,
    name: str = "value",
    dropna: bool = True,
    top: int | None = None,
    decimals: int = 2,
) -> DataFrame:
    """Count and share (percent of counted rows) per value, sorted by count
    descending then value; ``top`` keeps the first rows."""
    c = _col(column).alias(name)
    src = df.select(c)
    if dropna:
        src = src.filter(F.col(name).isNotNull())
    grouped = src.groupBy(name).agg(F.count(F.lit(1)).alias("count"))
    total = grouped.agg(F.sum("count")).scalar()
    out = grouped.withColumn("share_percent", pct(F.col("count"), total, decimals))
    out = out.orderBy(F.col("count").desc(), F.col(name).asc_nulls_first())
    return out.limit(top) if top is not None else out


def mode_share(df: DataFrame, column: ColumnOrName, *, decimals: int = 2) -> DataFrame:
    """Most frequent non-null value (ties -> smallest), its count and share.

    One aggregation: per-value counts, then ``min(struct(-count, value))``
    which is partially aggregated, so no group is ever gathered."""
    c = _col(column).alias("value")
    counts = df.select(c).filter(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")))
    out = counts.agg(best.alias("b"), F.sum("n").alias("total"))
    return out.select(F.col("b.value").alias("mode"), (-F.col("b.neg")).alias("mode_count"),
                      pct(-F.col("b.neg"), F.col("total"), decimals).alias("mode_share_percent"))


MAX_PIVOT_VALUES = 1_000


def modes(df: DataFrame, columns: Sequence[str]) -> dict:
    """Most frequent non-null value of each column (ties -> smallest).

    Per-value counts are a map-side combined group-by; the winner per
    column is a partially aggregated ``min(struct(-count, value))``, so no
    task ever holds a column's distinct values. Columns of one type share a
    pass (unpivoted into (column, value) rows). Columns without values are
    absent from the result."""
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    out = {}
    for cols in by_type.values():
        pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in cols]
        long = df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
        counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("value"))).alias("b"))
        out.update({r.column: r.b.value for r in best.collect()})  # one row per column
    return out


class TooManyHeaders(ValueError):
    """More distinct values than a wide table may have columns."""


def _distinct_values(df: DataFrame, column: str, limit: int = MAX_PIVOT_VALUES) -> list:
    """Pivot headers: the distinct non-null values of the column. They
    become output columns, so their number is checked (``limit`` + 1 fetched
    at most)."""
    rows = (df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)
            .limit(limit + 1).collect())
    if len(rows) > limit:
        raise TooManyHeaders(f"column {column!r} has more than {limit} distinct values; pass `values` explicitly")
    return [r[0] for r in rows]


def crosstab_cells(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts per (row, col) in long form, (row, col, count), for any number of
    values on either side; null keys and empty cells are left out."""
    src = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
    return src.groupBy(row, col).agg(F.count(F.lit(1)).alias("count"))


def crosstab_shares(df: DataFrame, row: str, col: str, normalize: str = "columns", decimals: int = 4) -> DataFrame:
    """(row, col, fraction): cells as fractions of their column's, row's
    (``index``) or the table's (``all``) total. Totals are aggregated cells
    joined back on the key."""
    cells = crosstab_cells(df, row, col).withColumnRenamed("count", "n")
    if normalize == "columns":
        cells = _totals_join(cells, [col], "n")
    elif normalize == "index":
        cells = _totals_join(cells, [row], "n")
    elif normalize == "all":
        cells = cells.withColumn("_total", cells.agg(F.sum("n")).scalar())
    else:
        raise ValueError(f"normalize must be columns, index or all, not {normalize!r}")
    return cells.select(row, col, F.round(F.try_divide(F.col("n"), F.col("_total")), decimals).alias("fraction"))


def _wide(cells: DataFrame, row: str, col: str, value: str, values: Sequence, empty: Column) -> DataFrame:
    wide = cells.groupBy(row).pivot(col, list(values)).agg(F.first(value))
    return wide.select(row, *[F.coalesce(F.col(f"`{v}`"), empty).alias(str(v)) for v in values])


def crosstab(
    df: DataFrame,
    row: str,
    col: str,
    values: Sequence | None = None,
) -> DataFrame:
    """Counts per (row, col) as a wide table, missing cells 0, null keys
    dropped (``pd.crosstab``). Column headers are the ``col`` values as text.
    Pass ``values`` to fix the header set (and skip the distinct job). A
    column with more values than a table may have columns gives the long form
    of ``crosstab_cells``."""
    src = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
    try:
        values = list(values) if values is not None else _distinct_values(src, col)
    except TooManyHeaders:
        return crosstab_cells(df, row, col)
    return _wide(crosstab_cells(df, row, col), row, col, "count", values, F.lit(0).cast("long"))


def crosstab_normalized(
    df: DataFrame,
    row: str,
    col: str,
    normalize: str = "columns",
    values: Sequence | None = None,
    decimals: int = 4,
) -> DataFrame:
    """Crosstab of fractions: ``columns`` -> each column sums to 1,
    ``index`` -> each row sums to 1, ``all`` -> the table sums to 1.

    Fractions are computed on the long form before the pivot; too many headers
    give that long form (``crosstab_shares``)."""
    shares = crosstab_shares(df, row, col, normalize, decimals)
    try:
        values = list(values) if values is not None else _distinct_values(df.filter(F.col(row).isNotNull()), col)
    except TooManyHeaders:
        return shares
    return _wide(shares, row, col, "fraction", values, F.lit(0.0))


def describe_numeric(
    df: DataFrame,
    columns: Sequence[str],
    percentiles: Sequence[float] = PERCENTILES,
    *,
    accuracy: int | None = None,
    decimals: int = 4,
) -> DataFrame:
    """One row per column: count, mean, sample std, min, percentiles, max.

    Moments and the first counts of the percentiles come from one aggregate over
    all columns; a column without values has a count of 0 and nulls."""
    pnames = [_pname(p) for p in percentiles]
    found = quantile_arrays(df, columns, percentiles, accuracy=accuracy, moments=True)
    named = df.sparkSession.createDataFrame(pa.table({"column": list(columns)}))
    out = F.broadcast(named).join(found, "column", "left").select(
        "column", F.coalesce("n", F.lit(0)).cast("long").alias("count"), "mean", "std", F.col("least").alias("min"),
        *[F.get("values", F.lit(i)).alias(n) for i, n in enumerate(pnames)], F.col("most").alias("max"))
    rd = lambda c: F.round(F.col(c), decimals).alias(c)
    return out.select("column", "count", rd("mean"), rd("std"), rd("min"), *[rd(n) for n in pnames], rd("max"))


def _melt_as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def describe_all(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    accuracy: int | None = None,
    decimals: int = 4,
) -> DataFrame:
    """``describe(include="all").T``: per column count, unique, top, freq
    (top ties -> smallest text) plus numeric statistics (null for text).

    Counting is one pass over an unpivoted (column, value) projection with
    a map-side combined group-by; no column's values are ever collected.
    """
    columns = list(columns or df.columns)
    numeric = [f.name for f in df.schema.fields if f.name in columns and isinstance(f.dataType, NumericType)]
    counts = (_melt_as_text(df, columns).filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")))
    cat = counts.groupBy("column").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("b"))
    cat = cat.select("column", "count", "unique", F.col("b.value").alias("top"), (-F.col("b.neg")).alias("freq"))
    if numeric:
        num = describe_numeric(df, numeric, accuracy=accuracy, decimals=decimals).drop("count")
        cat = cat.join(num, "column", "left")
    return cat


def group_summary(
    df: DataFrame,
    by: str,
    value: ColumnOrName,
    groups: Sequence | None = None,
    *,
    accuracy: int | None = None,
    decimals: int = 4,
) -> DataFrame:
    """Per group: count, mean, median, sample std, min, max of ``value``
    (nulls ignored, null group dropped). ``groups`` lists the groups to show
    in that order, absent groups as rows of nulls."""
    src = df.filter(F.col(by).isNotNull()).select(by, _col(value).cast("double").alias("_v"))
    v = F.when(~F.isnan("_v"), F.col("_v"))
    aggs = [F.count(v).alias("count"), F.round(F.avg(v), decimals).alias("mean"),
            F.round(F.stddev_samp(v), decimals).alias("std"),
            F.round(F.min(v), decimals).alias("min"), F.round(F.max(v), decimals).alias("max")]
    if accuracy:
        med = F.percentile_approx(v, 0.5, accuracy)
        out = src.groupBy(by).agg(*aggs, F.round(med, decimals).alias("median"))
    else:
        found = quantile_arrays(src, ["_v"], [0.5], [by], moments=True)
        rd = lambda c, name: F.round(c, decimals).alias(name)
        found = found.select(F.col(by).alias("_of"), F.col("n").alias("count"), rd("mean", "mean"), rd("std", "std"),
                             rd("least", "min"), rd("most", "max"), rd(F.col("values")[0], "median"))
        every = src.select(by).distinct()  # groups without a value are groups too
        out = every.join(found, F.col(by) == F.col("_of"), "left").withColumn("count", F.coalesce("count", F.lit(0)).cast("long"))
    out = out.select(by, "count", "mean", "median", "std", "min", "max")
    if groups is None:
        return out
    spark = df.sparkSession
    order = spark.createDataFrame([(g, i) for i, g in enumerate(groups)], [by, "_order"])
    # the group list is a parameter (bounded), so it is safe to broadcast
    return F.broadcast(order).join(out, by, "left").orderBy("_order").drop("_order")


def medians(df: DataFrame, columns: Sequence[str], *, accuracy: int | None = None) -> DataFrame:
    """One row with the median of each column (nulls ignored)."""
    long = quantiles_long(df, columns, [0.5], accuracy=accuracy)
    wide = long.groupBy().pivot("column", list(columns)).agg(F.first("value"))
    return wide.select(*[F.col(f"`{c}`").alias(c) for c in columns])


def hist_int(df: DataFrame, column: ColumnOrName, *, name: str = "value") -> DataFrame:
    """Integer histogram: values rounded half-to-even, counted, sorted."""
    v = F.bround(_col(column).cast("double"), 0).alias(name)
    return df.select(v).filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("count")).orderBy(name)


def hist_width(
    df: DataFrame,
    column: ColumnOrName,
    bins: int,
    by: str | None = None,
    *,
    decimals: int = 6,
) -> DataFrame:
    """Equal-width histogram over [min, max] (last bin closed), per group
    when ``by`` is given, with the density normalized within the group
    (count / (group count * width)). min/max are scalar subqueries."""
    v = _col(column).cast("double")
    src = df.select(*([F.col(by)] if by else []), v.alias("v")).filter(F.col("v").isNotNull())
    bounds = src.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()  # one subquery
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    width = F.when(hi > lo, (hi - lo) / F.lit(bins)).otherwise(F.lit(1.0))
    idx = F.when(hi > lo, F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    keys = ([F.col(by)] if by else []) + [idx.cast("int").alias("bin")]
    counts = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    group_total = F.sum("count").over(Window.partitionBy(by)) if by else F.lit(src.select(F.count(F.lit(1))).scalar())
    return counts.select(
        *([F.col(by)] if by else []), "bin",
        F.round(lo + F.col("bin") * width, decimals).alias("bin_start"),
        F.round(lo + (F.col("bin") + 1) * width, decimals).alias("bin_end"),
        "count",
        F.round(F.try_divide(F.col("count"), group_total * width), decimals).alias("density"))


def box_stats(
    df: DataFrame,
    value: ColumnOrName,
    by: str,
    *,
    accuracy: int | None = None,
    decimals: int = 4,
) -> DataFrame:
    """Box-plot statistics per group: quartiles (linear interpolation), IQR
    and whiskers = most extreme values within 1.5 IQR of the box.

    The per-group fences (one row per group, broadcast if their checked number
    allows it, so that rows are not shuffled by a hot group) are joined back to
    the rows and min/max taken inside them."""
    v = _col(value).cast("double")
    src = df.select(F.col(by), v.alias("v")).filter(F.col("v").isNotNull() & F.col(by).isNotNull())
    q = quantiles_wide(src, ["v"], PERCENTILES, ["q1", "median", "q3"], [by], accuracy=accuracy).drop("column")
    q = per_group(q.withColumn("iqr", F.col("q3") - F.col("q1")))
    fenced = src.join(q, by).where(
        (F.col("v") >= F.col("q1") - 1.5 * F.col("iqr")) & (F.col("v") <= F.col("q3") + 1.5 * F.col("iqr")))
    w = fenced.groupBy(by).agg(F.min("v").alias("whisker_low"), F.max("v").alias("whisker_high"))
    out = q.join(w, by)
    return out.select(by, *[F.round(F.col(c), decimals).alias(c)
                            for c in ("q1", "median", "q3", "iqr", "whisker_low", "whisker_high")])


def band_counts(
    df: DataFrame,
    column: ColumnOrName,
    edges: Sequence[float],
    labels: Sequence[str] | None = None,
    *,
    include_lowest: bool = True,
) -> DataFrame:
    """Counts per right-closed band (``pd.cut`` + ``value_counts`` sorted by
    band), every band listed, empty ones with 0."""
    band = bin_column(column, edges, labels, include_lowest=include_lowest)
    names = labels or [None] * (len(edges) - 1)
    spark = df.sparkSession
    if labels is None:
        from strata.functions.exprs import _interval_label
        names = [_interval_label(edges[i], edges[i + 1], True, include_lowest and i == 0)
                 for i in range(len(edges) - 1)]
    counts = df.select(band.alias("band")).filter(F.col("band").isNotNull()).groupBy("band").agg(
        F.count(F.lit(1)).alias("count"))
    order = spark.createDataFrame([(n, i) for i, n in enumerate(names)], ["band", "_order"])
    return (F.broadcast(order).join(counts, "band", "left")
            .select("band", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"), "_order")
            .orderBy("_order").drop("_order"))
