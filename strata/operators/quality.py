"""Schema checks, type standardization and data-quality profiles.

Checks that only look at the schema run no job. Profiles are single-pass
aggregates (one wide ``agg`` then ``stack``/``inline`` to long form) or one
map-side-combined group-by over an unpivoted (column, value) projection.
Failing checks raise with a bounded number of examples (``limit``), never
by collecting the offending rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from strata.functions.exprs import count_when, is_blank, pct


# ---------------------------------------------------------------------------
# Schema checks (no job)
# ---------------------------------------------------------------------------

def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> None:
    """Raise listing the missing required columns (sorted). Extra columns
    are allowed."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what} is missing required columns: {', '.join(missing)}")


# ---------------------------------------------------------------------------
# Type standardization
# ---------------------------------------------------------------------------

def _integer_checks(column: str) -> tuple[Column, Column, Column]:
    raw = F.col(f"`{column}`")
    text = raw.cast("string")
    as_long, as_double = text.try_cast("long"), text.try_cast("double")
    bad_parse = raw.isNotNull() & as_double.isNull()
    fractional = as_long.isNull() & as_double.isNotNull() & (as_double != F.floor(as_double))
    # integers never pass through double, which holds them only up to 2**53
    exact = F.coalesce(as_long, text.try_cast("decimal(38,6)").try_cast("long"), as_double.try_cast("long"))
    return exact, bad_parse, fractional


def check_rules(df: DataFrame, rules: Sequence[tuple[str, Column, Column]], max_examples: int = 10) -> None:
    """Raise on the first violated rule ``(message, violation, shown)``.

    All rules are counted in one aggregate; only for a violated rule are up
    to ``max_examples`` distinct offending ``shown`` values fetched
    (``limit``)."""
    if not rules:
        return
    counts = df.agg(*[F.sum(cond.cast("int")).alias(f"r{i}") for i, (_, cond, _) in enumerate(rules)]).first()
    for i, (message, cond, shown) in enumerate(rules):
        if counts[f"r{i}"]:
            offenders = df.filter(cond).select(shown.cast("string").alias("v")).distinct()
            examples = sorted(str(r.v) for r in offenders.limit(max_examples).collect())
            raise ValueError(f"{message}: {examples}")


def integer_rules(columns: Sequence[str]) -> list[tuple[str, Column, Column]]:
    """Violation rules of strict integer coercion for ``columns``."""
    rules = []
    for c in columns:
        _, bad, frac = _integer_checks(c)
        rules += [(f"Column '{c}' contains values that cannot be converted to integers", bad, F.col(f"`{c}`")),
                  (f"Column '{c}' contains non-integer values", frac, F.col(f"`{c}`"))]
    return rules


def strict_integers(df: DataFrame, columns: Sequence[str], max_examples: int = 10) -> dict[str, Column]:
    """Integer coercions that fail on unparsable or fractional values (one
    aggregate for all columns). Returns column -> coerced Column."""
    check_rules(df, integer_rules(columns), max_examples)
    return {c: _integer_checks(c)[0].cast("long") for c in columns}


def strict_integer(df: DataFrame, column: str, max_examples: int = 10) -> Column:
    """Single-column form of ``strict_integers``."""
    return strict_integers(df, [column], max_examples)[column]


def standardize_types(
    df: DataFrame,
    *,
    integers: Sequence[str] = (),
    doubles: Sequence[str] = (),
    strings: Sequence[str] = (),
    strict: bool = True,
) -> DataFrame:
    """Cast integer columns strictly (bad value raises), doubles leniently
    (bad -> null, NaN -> null) and strings as text. Missing columns are
    skipped; nothing is imputed."""
    present = set(df.columns)
    ints = [c for c in integers if c in present]
    if strict:
        cols = dict(strict_integers(df, ints))
    else:
        cols = {c: F.coalesce(F.col(c).cast("string").try_cast("long"),
                              F.col(c).cast("string").try_cast("double").try_cast("long")) for c in ints}
    for c in doubles:
        if c in present:
            d = F.col(c).cast("string").try_cast("double")
            cols[c] = F.when(F.isnan(d), F.lit(None)).otherwise(d)
    for c in strings:
        if c in present:
            cols[c] = F.col(c).cast("string")
    return df.withColumns(cols) if cols else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """Convert NaN to NULL in every floating column (pandas treats NaN as
    missing; Spark does not)."""
    cols = {f.name: F.when(F.isnan(F.col(f.name)), F.lit(None)).otherwise(F.col(f.name))
            for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.withColumns(cols) if cols else df


# ---------------------------------------------------------------------------
# Profiles
# ---------------------------------------------------------------------------

def _melt_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def unexpected_values(df: DataFrame, expected: Mapping[str, Iterable]) -> DataFrame:
    """(column, value) for every distinct non-null value outside the
    expected set of its column, sorted as text."""
    cols = [c for c in expected if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string")
    melted = _melt_text(df, cols).filter(F.col("value").isNotNull())
    allowed = F.lit(False)
    for c in cols:
        allowed = allowed | ((F.col("column") == c) & F.col("value").isin([str(v) for v in expected[c]]))
    return melted.filter(~allowed).distinct().orderBy("column", "value")


def range_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: for each named rule, the number of rows violating it."""
    return df.agg(*[count_when(cond).alias(name) for name, cond in rules.items()])


def missing_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    only_missing: bool = True,
    blank_as_missing: bool = False,
    decimals: int = 2,
) -> DataFrame:
    """Missing count, percent and fraction per column, most missing first.

    One aggregate computes all counts; ``stack`` makes it long."""
    columns = list(columns or df.columns)
    def miss(c):
        col = F.col(f"`{c}`")
        if blank_as_missing and isinstance(df.schema[c].dataType, StringType):
            return is_blank(col)
        return col.isNull()
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.coalesce(count_when(miss(c)), F.lit(0)).alias(f"m{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_count")) for i, c in enumerate(columns)]
    long = wide.select(F.col("_n"), F.inline(F.array(*rows)))
    out = long.select("column", "missing_count",
                      pct(F.col("missing_count"), F.col("_n"), decimals).alias("missing_percent"),
                      F.round(F.try_divide(F.col("missing_count"), F.col("_n")), 6).alias("missing_fraction"))
    if only_missing:
        out = out.filter(F.col("missing_count") > 0)
    return out.orderBy(F.col("missing_count").desc(), "column")


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, distinct rows and duplicates (nulls compare equal).

    A group-by on all columns with map-side combine; each group emits one
    row, so a hot duplicated row costs one partial row per partition."""
    cols = list(columns or df.columns)
    groups = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.sum("n").cast("long").alias("row_count"),
                      F.count(F.lit(1)).alias("distinct_rows"),
                      F.sum(F.col("n") - 1).cast("long").alias("duplicate_rows"))


def duplicate_ids(df: DataFrame, id_column: str, examples: int = 10) -> DataFrame:
    """One row: null ids, number of duplicated ids, rows involved and the
    first ``examples`` duplicated ids in ascending order."""
    counts = df.groupBy(id_column).agg(F.count(F.lit(1)).alias("n"))
    dup = counts.filter(F.col(id_column).isNotNull() & (F.col("n") > 1))
    first = dup.orderBy(id_column).limit(examples).agg(
        F.array_sort(F.collect_list(id_column)).alias("example_ids"))
    stats = counts.agg(F.coalesce(F.sum(F.when(F.col(id_column).isNull(), F.col("n"))), F.lit(0)).cast("long")
                       .alias("null_ids"),
                       count_when(F.col(id_column).isNotNull() & (F.col("n") > 1)).alias("duplicated_ids"),
                       F.coalesce(F.sum(F.when(F.col(id_column).isNotNull() & (F.col("n") > 1), F.col("n"))),
                                  F.lit(0)).cast("long").alias("duplicated_rows"))
    return stats.withColumn("example_ids", first.select("example_ids").scalar())


def validate_ids(df: DataFrame, id_column: str) -> None:
    """Raise when ids are null or duplicated (first 10 offenders listed)."""
    row = duplicate_ids(df, id_column).first()
    if row.null_ids:
        raise ValueError(f"Column '{id_column}' contains {row.null_ids} missing identifiers")
    if row.duplicated_ids:
        raise ValueError(f"Column '{id_column}' contains duplicate identifiers: {list(row.example_ids)}")


def type_profile(df: DataFrame, columns: Sequence[str] | None = None, *,
                 relative_sd: float | None = None) -> DataFrame:
    """Column, Spark type, kind (numeric/categorical) and distinct non-null
    count: exact, each column's values counted in their own type by one
    aggregate over one scan, or, with ``relative_sd``, HyperLogLog++ estimates
    (no shuffle of the values) for very large or wide tables. Maps count as text."""
    columns = list(columns or df.columns)

    def distinct_count(c: str) -> Column:
        v = F.col(f"`{c}`")
        v = v.cast("string") if "map<" in df.schema[c].dataType.simpleString() else v
        return F.count_distinct(v) if relative_sd is None else F.approx_count_distinct(v, relative_sd)

    wide = df.agg(*[distinct_count(c).alias(f"d{i}") for i, c in enumerate(columns)])
    distinct = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("distinct_count")) for i, c in enumerate(columns)])))
    spark = df.sparkSession
    meta = spark.createDataFrame(
        [(c, df.schema[c].dataType.simpleString(),
          "numeric" if isinstance(df.schema[c].dataType, NumericType) else "categorical", i)
         for i, c in enumerate(columns)], "column string, dtype string, kind string, _pos int")
    return (F.broadcast(meta).join(distinct, "column", "left")
            .select("column", "dtype", "kind", F.coalesce("distinct_count", F.lit(0)).cast("long").alias("distinct_count"),
                    "_pos").orderBy("_pos").drop("_pos"))


def numeric_like(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.80) -> DataFrame:
    """Per column: share of rows whose value parses as a number and whether
    the column counts as numeric (numeric type, or share >= threshold)."""
    columns = list(columns or df.columns)
    aggs = [F.avg(F.col(f"`{c}`").cast("string").try_cast("double").isNotNull().cast("double")).alias(f"r{i}")
            for i, c in enumerate(columns)]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.round(F.coalesce(F.col(f"r{i}"), F.lit(0.0)), 6).alias("parse_share"),
                     F.lit(isinstance(df.schema[c].dataType, NumericType)).alias("is_numeric_type"))
            for i, c in enumerate(columns)]
    out = wide.select(F.inline(F.array(*rows)))
    return out.withColumn("is_numeric", F.col("is_numeric_type") | (F.col("parse_share") >= threshold)).drop(
        "is_numeric_type")


def coerce_numeric_like(df: DataFrame, threshold: float = 0.80) -> DataFrame:
    """Convert mostly-numeric text columns to doubles (bad -> null)."""
    flags = numeric_like(df, [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)], threshold)
    convert = [r.column for r in flags.filter("is_numeric").collect()]  # one row per column: schema-sized
    return df.withColumns({c: F.col(f"`{c}`").try_cast("double") for c in convert}) if convert else df


def value_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min and max of finite values per numeric column (long form)."""
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`").cast("double")
        finite = F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)
        aggs += [F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"))
            for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows)))


def available_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values as text (choices for a filter)."""
    return df.select(F.col(column).cast("string").alias("value")).filter(F.col("value").isNotNull()).distinct().orderBy(
        "value")


def quality_report(
    df: DataFrame,
    *,
    id_column: str | None = None,
    expected: Mapping[str, Iterable] | None = None,
    ranges: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Long-form report ``(section, column, metric, value)``: shape, missing
    values, duplicates, type profile, unexpected values, range violations.

    One scan: every row gives one key for each column (the value, in its own
    type) and one for the whole row; equal keys are counted map-side, and all
    sections follow from those counts. Maps count as text."""
    names, spark = df.columns, df.sparkSession
    kinds = [df.schema[c].dataType for c in names]
    typed = [F.col(f"`{c}`").cast("string") if "map<" in t.simpleString() else F.col(f"`{c}`") for c, t in zip(names, kinds)]
    ranges = dict(ranges or {})
    cells = df.select(*[c.alias(f"_c{i}") for i, c in enumerate(typed)],
                      *[cond.cast("int").alias(f"_r{i}") for i, cond in enumerate(ranges.values())])
    types = [cells.schema[f"_c{i}"].dataType.simpleString() for i in range(len(names))]

    def key(kind: int) -> str:  # -1 is the whole row, else the number of the column
        fields = [f"'_k{i}', " + (f"_c{i}" if kind in (-1, i) else f"cast(NULL AS {t})") for i, t in enumerate(types)]
        return f"named_struct('_kind', {kind}, {', '.join(fields)})"

    keys = f"inline(array({', '.join(key(k) for k in range(-1, len(names)))}))"
    keyed = cells.selectExpr(*[f"_r{i}" for i in range(len(ranges))], keys)
    sums = [f"sum(if(_kind = -1, _r{i}, 0)) AS _r{i}" for i in range(len(ranges))]
    counted = keyed.groupBy("_kind", *[f"_k{i}" for i in range(len(names))]).agg(F.expr("count(1) AS n"), *map(F.expr, sums))

    own = "CASE _kind " + " ".join(f"WHEN {i} THEN _k{i} IS NULL" for i in range(len(names))) + " ELSE false END"
    odd = F.lit(None).cast("string")
    for c, allowed in (expected or {}).items():
        if c in names:
            i, text = names.index(c), F.col(f"_k{names.index(c)}").cast("string")
            odd = F.when((F.col("_kind") == i) & ~text.isin([str(v) for v in allowed]), text).otherwise(odd)
    counted = counted.select("_kind", "n", F.expr(own).alias("_null"), odd.alias("_odd"), *[f"_r{i}" for i in range(len(ranges))])
    # a row of each kind that counts nothing: an empty table is reported too
    nothing = spark.range(-1, len(names)).selectExpr(
        "int(id) AS _kind", "0L AS n", "true AS _null", "string(NULL) AS _odd", *[f"0L AS _r{i}" for i in range(len(ranges))])
    totals = counted.unionByName(nothing).rollup("_kind", "_odd").agg(
        F.grouping_id().alias("_of"), F.expr("sum(n) AS row_count"), F.expr("sum(n) FILTER (WHERE _null) AS missing"),
        F.expr("count_if(NOT _null) AS distinct_count"), F.expr("sum(n) - count_if(n > 0) AS repeated"),
        F.expr("count_if(n > 1 AND NOT _null) AS repeated_keys"), *[F.expr(f"sum(_r{i}) AS _r{i}") for i in range(len(ranges))])

    whole, column = F.col("_kind") == -1, F.col("_kind") >= 0
    total, listed = F.col("_of") == 1, (F.col("_of") == 0) & F.col("_odd").isNotNull()
    missing = F.coalesce("missing", F.lit(0))
    name_of = F.when(column, F.get(F.array(*[F.lit(c) for c in names]), F.col("_kind"))).otherwise("*")
    dtype_of = F.get(F.array(*[F.lit(t.simpleString()) for t in kinds]), F.col("_kind"))
    lines = [
        ("shape", whole & total, "rows", F.col("row_count")),
        ("shape", whole & total, "columns", F.lit(len(names))),
        ("missing", column & total & (missing > 0), "missing_count", missing),
        ("missing", column & total & (missing > 0), "missing_percent", pct(missing, F.col("row_count"), 2)),
        ("duplicates", whole & total, "duplicate_rows", F.col("repeated")),
        ("types", column & total, "dtype", dtype_of),
        ("types", column & total, "distinct_count", F.col("distinct_count")),
        ("unexpected", column & listed, "value", F.col("_odd")),
        *[("ranges", whole & total, n, F.col(f"_r{i}")) for i, n in enumerate(ranges)],
    ]
    if id_column:
        lines.append(("duplicates", total & (F.col("_kind") == names.index(id_column)), "duplicated_ids", F.col("repeated_keys")))
    report = F.array(*[
        F.when(cond, F.struct(F.lit(section).alias("section"), name_of.alias("column"), F.lit(metric).alias("metric"),
                              value.cast("string").alias("value"))) for section, cond, metric, value in lines])
    return totals.select(F.inline(F.filter(report, lambda x: x.isNotNull())))


def preparation_summary(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows/columns before and after preparation and the added columns."""
    added = [c for c in processed.columns if c not in raw.columns]
    n_raw = raw.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    n_proc = processed.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    spark = raw.sparkSession
    base = spark.range(1).select(
        n_raw.alias("raw_rows"), F.lit(len(raw.columns)).alias("raw_columns"),
        n_proc.alias("processed_rows"), F.lit(len(processed.columns)).alias("processed_columns"),
        F.array(*[F.lit(c) for c in added]).cast("array<string>").alias("added_columns"))
    return base


def label_checks(df: DataFrame, label: str, min_classes: int = 2) -> DataFrame:
    """One aggregate over the label: rows, null labels, distinct classes.
    ``assert_trainable`` raises on empty input, null labels or < 2 classes."""
    return df.agg(F.count(F.lit(1)).alias("rows"), count_when(F.col(label).isNull()).alias("null_labels"),
                  F.count_distinct(F.col(label)).alias("classes"))


def assert_trainable(df: DataFrame, label: str, features: Sequence[str] = (), min_classes: int = 2) -> None:
    require_columns(df, [label, *features], "training data")
    r = label_checks(df, label).first()
    if r.rows == 0:
        raise ValueError("training data is empty")
    if r.null_labels:
        raise ValueError(f"target column '{label}' contains {r.null_labels} missing values")
    if r.classes < min_classes:
        raise ValueError(f"target column '{label}' needs at least {min_classes} classes, found {r.classes}")


def domain_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Same as ``range_violations``; ``assert_domain`` raises if any > 0."""
    return range_violations(df, rules)


def assert_domain(df: DataFrame, rules: Mapping[str, Column]) -> None:
    row = domain_violations(df, rules).first().asDict()
    broken = {k: v for k, v in row.items() if v}
    if broken:
        raise ValueError(f"domain checks failed: {broken}")
