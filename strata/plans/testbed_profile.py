"""Describe, quality, filter and set-operation queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators import describe as D
from strata.operators import filters as FL
from strata.operators import quality as Q
from strata.operators import setops as S
from strata.plans.registry import register, table

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _crosstab_sql(agg: str) -> str:
    return ",\n       ".join(agg.format(v=v) for v in PRIORITIES)


@register("value_counts", "A15", oracle="""
SELECT user_id AS value, COUNT(*) AS count,
       ROUND(100.0 * CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), 2) AS share_percent
FROM events WHERE user_id IS NOT NULL GROUP BY user_id
ORDER BY count DESC, value LIMIT 20
""")
def q_value_counts(spark, sf):
    return D.value_counts(table(spark, sf, "events"), "user_id", top=20)


@register("mode_share", "A16 M03", oracle="""
WITH c AS (SELECT user_id AS value, COUNT(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY user_id)
SELECT value AS mode, n AS mode_count,
       ROUND(100.0 * CAST(n AS DOUBLE) / (SELECT SUM(n) FROM c), 2) AS mode_share_percent
FROM c ORDER BY n DESC, value LIMIT 1
""")
def q_mode_share(spark, sf):
    return D.mode_share(table(spark, sf, "events"), "user_id")


@register("crosstab", "A17", oracle=f"""
SELECT o_orderstatus,
       {_crosstab_sql('CAST(SUM(CASE WHEN o_orderpriority = {v!r} THEN 1 ELSE 0 END) AS BIGINT) AS "{v}"')}
FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY o_orderstatus
""")
def q_crosstab(spark, sf):
    return D.crosstab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@register("crosstab_cells", "A17", oracle="""
SELECT o_custkey, o_orderpriority, COUNT(*) AS count FROM orders
WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY ALL
""")
def q_crosstab_cells(spark, sf):
    return D.crosstab_cells(table(spark, sf, "orders"), "o_custkey", "o_orderpriority")


@register("crosstab_shares", "A18 N02", oracle="""
SELECT o_orderstatus, o_custkey, ROUND(n / SUM(n) OVER (PARTITION BY o_custkey), 4) AS fraction
FROM (SELECT o_orderstatus, o_custkey, COUNT(*) AS n FROM orders
      WHERE o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY ALL)
""")
def q_crosstab_shares(spark, sf):
    return D.crosstab_shares(table(spark, sf, "orders"), "o_orderstatus", "o_custkey", "columns")


@register("crosstab_norm", "A18 N02", oracle=f"""
WITH cells AS (
  SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM orders
  WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY ALL),
f AS (SELECT o_orderstatus, o_orderpriority,
             ROUND(n / SUM(n) OVER (PARTITION BY o_orderpriority), 4) AS f FROM cells)
SELECT o_orderstatus,
       {_crosstab_sql('COALESCE(MAX(CASE WHEN o_orderpriority = {v!r} THEN f END), 0.0) AS "{v}"')}
FROM f GROUP BY o_orderstatus
""")
def q_crosstab_norm(spark, sf):
    return D.crosstab_normalized(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", "columns")


_DESCRIBE_COLS = ("l_quantity", "l_extendedprice", "l_discount")


def _describe_sql(cols, source="lineitem"):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", COUNT({c}) AS count, ROUND(AVG({c}), 4) AS mean,
  ROUND(STDDEV_SAMP({c}), 4) AS std, ROUND(MIN({c}), 4) AS min,
  ROUND(QUANTILE_CONT({c}, 0.25), 4) AS p25, ROUND(QUANTILE_CONT({c}, 0.5), 4) AS p50,
  ROUND(QUANTILE_CONT({c}, 0.75), 4) AS p75, ROUND(MAX({c}), 4) AS max FROM {source}""")
    return "\nUNION ALL\n".join(parts)


@register("describe", "A19", oracle=_describe_sql(_DESCRIBE_COLS))
def q_describe(spark, sf):
    return D.describe_numeric(table(spark, sf, "lineitem"), list(_DESCRIBE_COLS))


_PART = {"p_partkey": True, "p_name": False, "p_brand": False, "p_type": False, "p_size": True, "p_retailprice": True}


def _describe_all_sql(values: str) -> str:
    number = " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", ROUND(AVG({c}), 4) AS mean, ROUND(STDDEV_SAMP({c}), 4) AS std, ROUND(MIN({c})::DOUBLE, 4) AS min,
        ROUND(QUANTILE_CONT({c}, 0.25), 4) AS p25, ROUND(QUANTILE_CONT({c}, 0.5), 4) AS p50,
        ROUND(QUANTILE_CONT({c}, 0.75), 4) AS p75, ROUND(MAX({c})::DOUBLE, 4) AS max FROM part""" for c, n in _PART.items() if n)
    return f"""
WITH melted AS ({values}),
counts AS (SELECT "column", value, COUNT(*) AS n FROM melted WHERE value IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rk FROM counts),
cat AS (SELECT "column", SUM(n)::BIGINT AS count, COUNT(*) AS "unique",
               MAX(CASE WHEN rk = 1 THEN value END) AS top, MAX(CASE WHEN rk = 1 THEN n END) AS freq
        FROM ranked GROUP BY "column"),
num AS ({number})
SELECT cat.*, num.mean, num.std, num.min, num.p25, num.p50, num.p75, num.max FROM cat LEFT JOIN num USING ("column")
"""


@register("describe_all", "A20", oracle=_describe_all_sql(
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM part" for c in _PART)))
def q_describe_all(spark, sf):
    return D.describe_all(table(spark, sf, "part"))


@register("group_summary", "A13", oracle="""
WITH g AS (SELECT * FROM (VALUES ('R', 0), ('A', 1), ('N', 2), ('X', 3)) t(l_returnflag, _order)),
s AS (SELECT l_returnflag, COUNT(l_extendedprice) AS count, ROUND(AVG(l_extendedprice), 4) AS mean,
             ROUND(MEDIAN(l_extendedprice), 4) AS median, ROUND(STDDEV_SAMP(l_extendedprice), 4) AS std,
             ROUND(MIN(l_extendedprice), 4) AS min, ROUND(MAX(l_extendedprice), 4) AS max
      FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag)
SELECT g.l_returnflag, s.count, s.mean, s.median, s.std, s.min, s.max FROM g LEFT JOIN s USING (l_returnflag)
""")
def q_group_summary(spark, sf):
    return D.group_summary(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", ["R", "A", "N", "X"])


@register("medians", "A28 M01", oracle="""
SELECT ROUND(MEDIAN(l_quantity), 6) AS l_quantity, ROUND(MEDIAN(l_extendedprice), 6) AS l_extendedprice,
       ROUND(MEDIAN(l_discount), 6) AS l_discount FROM lineitem
""")
def q_medians(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    return D.medians(table(spark, sf, "lineitem"), cols).select(*[F.round(c, 6).alias(c) for c in cols])


@register("hist_int", "A21", oracle="""
SELECT ROUND_EVEN(value, 0) AS value, COUNT(*) AS count FROM events
WHERE value IS NOT NULL GROUP BY 1
""")
def q_hist_int(spark, sf):
    return D.hist_int(table(spark, sf, "events"), "value")


@register("hist_width", "A22", oracle="""
WITH b AS (SELECT MIN(n_chars)::DOUBLE AS lo, MAX(n_chars)::DOUBLE AS hi FROM documents),
w AS (SELECT lo, hi, CASE WHEN hi > lo THEN (hi - lo) / 25 ELSE 1.0 END AS width FROM b),
x AS (SELECT d.lang, CAST(CASE WHEN w.hi > w.lo THEN LEAST(FLOOR((d.n_chars - w.lo) / w.width), 24) ELSE 0 END AS INT)
             AS bin, w.lo, w.width
      FROM documents d, w WHERE d.n_chars IS NOT NULL),
c AS (SELECT lang, bin, ANY_VALUE(lo) AS lo, ANY_VALUE(width) AS width, COUNT(*) AS count FROM x GROUP BY lang, bin)
SELECT lang, bin, ROUND(lo + bin * width, 6) AS bin_start, ROUND(lo + (bin + 1) * width, 6) AS bin_end, count,
       ROUND(count / (SUM(count) OVER (PARTITION BY lang) * width), 6) AS density
FROM c
""")
def q_hist_width(spark, sf):
    return D.hist_width(table(spark, sf, "documents"), "n_chars", 25, by="lang")


@register("box_stats", "A23", oracle="""
WITH src AS (SELECT l_returnflag, l_extendedprice AS v FROM lineitem
             WHERE l_extendedprice IS NOT NULL AND l_returnflag IS NOT NULL),
q AS (SELECT l_returnflag, QUANTILE_CONT(v, 0.25) AS q1, QUANTILE_CONT(v, 0.5) AS median,
             QUANTILE_CONT(v, 0.75) AS q3 FROM src GROUP BY l_returnflag),
w AS (SELECT s.l_returnflag, MIN(v) AS whisker_low, MAX(v) AS whisker_high FROM src s JOIN q USING (l_returnflag)
      WHERE v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) GROUP BY s.l_returnflag)
SELECT l_returnflag, ROUND(q1, 4) AS q1, ROUND(median, 4) AS median, ROUND(q3, 4) AS q3,
       ROUND(q3 - q1, 4) AS iqr, ROUND(whisker_low, 4) AS whisker_low, ROUND(whisker_high, 4) AS whisker_high
FROM q JOIN w USING (l_returnflag)
""")
def q_box_stats(spark, sf):
    return D.box_stats(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")


@register("band_counts", "A24 P19", oracle="""
WITH b AS (SELECT * FROM (VALUES ('(-0.001, 0.5]', 0), ('(0.5, 0.6]', 1), ('(0.6, 0.7]', 2), ('(0.7, 0.8]', 3),
                                 ('(0.8, 0.9]', 4), ('(0.9, 1.0]', 5)) t(band, _o)),
x AS (SELECT l_discount * 10 AS v FROM lineitem),
c AS (SELECT CASE WHEN v >= 0 AND v <= 0.5 THEN '(-0.001, 0.5]' WHEN v > 0.5 AND v <= 0.6 THEN '(0.5, 0.6]'
                  WHEN v > 0.6 AND v <= 0.7 THEN '(0.6, 0.7]' WHEN v > 0.7 AND v <= 0.8 THEN '(0.7, 0.8]'
                  WHEN v > 0.8 AND v <= 0.9 THEN '(0.8, 0.9]' WHEN v > 0.9 AND v <= 1.0 THEN '(0.9, 1.0]' END AS band
      FROM x)
SELECT b.band, COALESCE(COUNT(c.band), 0)::BIGINT AS count FROM b LEFT JOIN c USING (band) GROUP BY b.band
""")
def q_band_counts(spark, sf):
    li = table(spark, sf, "lineitem").select((F.col("l_discount") * 10).alias("v"))
    return D.band_counts(li, "v", X.CONFIDENCE_BAND_EDGES)


# --------------------------------------------------------------------------
# Quality
# --------------------------------------------------------------------------

_ORDERS_NULLED = """(SELECT o_orderkey, o_custkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus,
    o_totalprice, o_orderdate, NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders)"""


def _orders_nulled(spark, sf):
    return table(spark, sf, "orders").withColumns({
        "o_orderstatus": F.nullif("o_orderstatus", F.lit("P")),
        "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW"))})


@register("missing_profile", "V07 V08", oracle=f"""
WITH t AS {_ORDERS_NULLED}, m AS (
  SELECT 'o_orderkey' AS "column", COUNT(*) - COUNT(o_orderkey) AS missing_count, COUNT(*) AS n FROM t
  UNION ALL SELECT 'o_custkey', COUNT(*) - COUNT(o_custkey), COUNT(*) FROM t
  UNION ALL SELECT 'o_orderstatus', COUNT(*) - COUNT(o_orderstatus), COUNT(*) FROM t
  UNION ALL SELECT 'o_totalprice', COUNT(*) - COUNT(o_totalprice), COUNT(*) FROM t
  UNION ALL SELECT 'o_orderdate', COUNT(*) - COUNT(o_orderdate), COUNT(*) FROM t
  UNION ALL SELECT 'o_orderpriority', COUNT(*) - COUNT(o_orderpriority), COUNT(*) FROM t)
SELECT "column", missing_count, ROUND(100.0 * CAST(missing_count AS DOUBLE) / n, 2) AS missing_percent,
       ROUND(missing_count / n, 6) AS missing_fraction
FROM m WHERE missing_count > 0
""")
def q_missing_profile(spark, sf):
    return Q.missing_profile(_orders_nulled(spark, sf))


@register("duplicates", "V09", oracle="""
WITH twice AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1),
g AS (SELECT *, COUNT(*) AS n FROM twice GROUP BY ALL)
SELECT SUM(n)::BIGINT AS row_count, COUNT(*) AS distinct_rows, SUM(n - 1)::BIGINT AS duplicate_rows FROM g
""")
def q_duplicates(spark, sf):
    # whole rows of all columns; the first lines of the orders stand twice
    li = table(spark, sf, "lineitem")
    return Q.duplicate_rows(li.unionByName(li.filter("l_linenumber = 1")))


@register("duplicate_ids", "V10", oracle="""
WITH c AS (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey),
d AS (SELECT l_orderkey FROM c WHERE l_orderkey IS NOT NULL AND n > 1 ORDER BY l_orderkey LIMIT 10)
SELECT COALESCE(SUM(CASE WHEN l_orderkey IS NULL THEN n END), 0)::BIGINT AS null_ids,
       SUM(CASE WHEN l_orderkey IS NOT NULL AND n > 1 THEN 1 ELSE 0 END)::BIGINT AS duplicated_ids,
       COALESCE(SUM(CASE WHEN l_orderkey IS NOT NULL AND n > 1 THEN n END), 0)::BIGINT AS duplicated_rows,
       (SELECT '[' || array_to_string(list_sort(list(l_orderkey)), ', ') || ']' FROM d) AS example_ids
FROM c
""")
def q_duplicate_ids(spark, sf):
    out = Q.duplicate_ids(table(spark, sf, "lineitem"), "l_orderkey")
    return out.withColumn("example_ids", X.ids_json("example_ids"))


@register("type_profile", "V11", oracle="""
WITH meta AS (SELECT * FROM (VALUES ('p_partkey', 'bigint', 'numeric'), ('p_name', 'string', 'categorical'),
    ('p_brand', 'string', 'categorical'), ('p_type', 'string', 'categorical'), ('p_size', 'int', 'numeric'),
    ('p_retailprice', 'double', 'numeric')) t("column", dtype, kind)),
d AS (SELECT 'p_partkey' AS "column", COUNT(DISTINCT p_partkey) AS distinct_count FROM part
      UNION ALL SELECT 'p_name', COUNT(DISTINCT p_name) FROM part
      UNION ALL SELECT 'p_brand', COUNT(DISTINCT p_brand) FROM part
      UNION ALL SELECT 'p_type', COUNT(DISTINCT p_type) FROM part
      UNION ALL SELECT 'p_size', COUNT(DISTINCT p_size) FROM part
      UNION ALL SELECT 'p_retailprice', COUNT(DISTINCT p_retailprice) FROM part)
SELECT meta."column", dtype, kind, d.distinct_count FROM meta JOIN d USING ("column")
""")
def q_type_profile(spark, sf):
    return Q.type_profile(table(spark, sf, "part"))


@register("numeric_like", "V12", oracle="""
WITH t AS (SELECT c_name, CAST(c_acctbal AS VARCHAR) AS bal, c_mktsegment,
                  CASE WHEN c_custkey % 4 = 0 THEN 'n/a' ELSE CAST(c_custkey AS VARCHAR) END AS mostly FROM customer)
SELECT 'c_name' AS "column", ROUND(AVG(CASE WHEN TRY_CAST(c_name AS DOUBLE) IS NOT NULL THEN 1.0 ELSE 0.0 END), 6)
       AS parse_share, false AS is_numeric FROM t
UNION ALL SELECT 'bal', ROUND(AVG(CASE WHEN TRY_CAST(bal AS DOUBLE) IS NOT NULL THEN 1.0 ELSE 0.0 END), 6), true FROM t
UNION ALL SELECT 'c_mktsegment', ROUND(AVG(CASE WHEN TRY_CAST(c_mktsegment AS DOUBLE) IS NOT NULL THEN 1.0 ELSE 0.0 END), 6),
                 false FROM t
UNION ALL SELECT 'mostly', ROUND(AVG(CASE WHEN TRY_CAST(mostly AS DOUBLE) IS NOT NULL THEN 1.0 ELSE 0.0 END), 6),
                 AVG(CASE WHEN TRY_CAST(mostly AS DOUBLE) IS NOT NULL THEN 1.0 ELSE 0.0 END) >= 0.8 FROM t
""")
def q_numeric_like(spark, sf):
    c = table(spark, sf, "customer")
    # every 4th key is replaced by text, so 'mostly' parses for 75 % of rows
    t = c.select("c_name", F.col("c_acctbal").cast("string").alias("bal"), "c_mktsegment",
                 F.when(F.col("c_custkey") % 4 == 0, F.lit("n/a")).otherwise(F.col("c_custkey").cast("string"))
                 .alias("mostly"))
    return Q.numeric_like(t)


@register("unexpected_values", "V05 X01", oracle="""
SELECT "column", value FROM (
  SELECT DISTINCT 'p_brand' AS "column", p_brand AS value FROM part
  WHERE p_brand IS NOT NULL AND p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5')
  UNION ALL
  SELECT DISTINCT 'p_type', p_type FROM part WHERE p_type IS NOT NULL AND p_type NOT IN ('ECONOMY', 'SMALL'))
""")
def q_unexpected_values(spark, sf):
    return Q.unexpected_values(table(spark, sf, "part"), {
        "p_brand": [f"Brand#{i}" for i in range(1, 6)], "p_type": ["ECONOMY", "SMALL"]})


@register("range_violations", "V06", oracle="""
SELECT SUM(CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END)::BIGINT AS quantity_above_45,
       SUM(CASE WHEN l_discount < 0 THEN 1 ELSE 0 END)::BIGINT AS negative_discount,
       SUM(CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END)::BIGINT AS tax_above_7pct
FROM lineitem
""")
def q_range_violations(spark, sf):
    return Q.range_violations(table(spark, sf, "lineitem"), {
        "quantity_above_45": F.col("l_quantity") > 45, "negative_discount": F.col("l_discount") < 0,
        "tax_above_7pct": F.col("l_tax") > 0.07})


@register("value_bounds", "V18", oracle="""
SELECT 'l_quantity' AS "column", MIN(l_quantity) AS min_value, MAX(l_quantity) AS max_value FROM lineitem
UNION ALL SELECT 'l_extendedprice', MIN(l_extendedprice), MAX(l_extendedprice) FROM lineitem
""")
def q_value_bounds(spark, sf):
    return Q.value_bounds(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])


@register("available_values", "V18", oracle="SELECT DISTINCT CAST(p_type AS VARCHAR) AS value FROM part WHERE p_type IS NOT NULL")
def q_available_values(spark, sf):
    return Q.available_values(table(spark, sf, "part"), "p_type")


# --------------------------------------------------------------------------
# Filters, search, arrangement, set operations
# --------------------------------------------------------------------------

@register("filter_spec", "P05 P06 P07 P08 P09", oracle="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE CAST(l_returnflag AS VARCHAR) IN ('A', 'R')
  AND TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) BETWEEN 10 AND 30
  AND NULLIF(l_tax, 0.0) IS NOT NULL
  AND (CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END) + 1 = 1
""")
def q_filter_spec(spark, sf):
    li = table(spark, sf, "lineitem").withColumns({
        "tax_or_null": F.nullif(F.col("l_tax"), F.lit(0.0)),
        "companions": F.when(F.col("l_linenumber") == 1, 0).otherwise(1)})
    spec = FL.FilterSpec(isin={"l_returnflag": ["A", "R"]}, ranges={"l_quantity": (10, 30)},
                         presence=("has_tax", "tax_or_null", 1), group=("group_size", ["companions"], "alone"))
    return FL.apply_filters(li, spec).select("l_orderkey", "l_linenumber", "l_quantity")


@register("literal_search", "P10", oracle="""
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE contains(lower(c_name), 'er#0000001') OR contains(lower(c_mktsegment), 'er#0000001')
""")
def q_literal_search(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return FL.literal_search(c, "ER#0000001", ["c_name", "c_mktsegment"])


@register("row_search", "P11", oracle="""
SELECT * FROM customer WHERE contains(lower(concat_ws(' ', COALESCE(CAST(c_custkey AS VARCHAR), ''), COALESCE(c_name, ''),
    COALESCE(CAST(c_nationkey AS VARCHAR), ''), COALESCE(CAST(c_acctbal AS VARCHAR), ''), COALESCE(c_mktsegment, ''))), '7 customer#')
""")
def q_row_search(spark, sf):
    return FL.row_search(table(spark, sf, "customer"), "7 Customer#")


@register("reorder_rename", "P01 P02 P03", oracle="""
SELECT p_size AS size, p_name AS name, p_partkey, p_brand AS brand, p_type, p_retailprice FROM part
""")
def q_reorder_rename(spark, sf):
    p = FL.reorder_columns(table(spark, sf, "part"), ["p_size", "missing_col", "p_name"])
    return FL.rename_columns(p, {"p_size": "size", "p_name": "name", "p_brand": "brand"})


@register("unpivot", "P16", oracle="""
SELECT l_orderkey, l_linenumber, CASE variable WHEN 'l_quantity' THEN 'Quantity' ELSE variable END AS variable, value
FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, NULLIF(l_discount, 0.0) AS l_discount FROM lineitem)
      ON l_quantity, l_discount INTO NAME variable VALUE value)
WHERE value IS NOT NULL
""")
def q_unpivot(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                             F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"))
    return FL.unpivot_values(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount"],
                             labels={"l_quantity": "Quantity"})


@register("values_outside", "X01", oracle="""
SELECT DISTINCT c_nationkey AS value FROM customer
WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)
""")
def q_values_outside(spark, sf):
    nations = table(spark, sf, "nation").filter(F.col("n_regionkey") == 1).select("n_nationkey")
    return S.values_outside(table(spark, sf, "customer"), "c_nationkey", nations)


@register("label_union", "X02", oracle="""
SELECT DISTINCT label FROM (SELECT l_linestatus AS label FROM lineitem UNION ALL SELECT o_orderstatus FROM orders)
WHERE label IS NOT NULL
""")
def q_label_union(spark, sf):
    return S.label_union(table(spark, sf, "lineitem"), "l_linestatus", table(spark, sf, "orders"), "o_orderstatus")
