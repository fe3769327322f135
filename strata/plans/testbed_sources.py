"""Source/sink and report-style queries: CSV round trip through the
dispatching reader, SQL utilities (tables, scripts, parameters, object
listing), the long-form quality report, preparation summary, label checks.
Scratch files go under the session's checkpoint folder (shared storage on a
cluster)."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata.operators import cohort as C
from strata.operators import quality as Q
from strata.operators.rows import with_row_number
from strata.plans.registry import register, table
from strata.session import checkpoint_dir
from strata.sources import io as IO

ORDERS_SCHEMA = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                 "o_orderdate timestamp, o_orderpriority string")


def _scratch(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


@register("csv_roundtrip", "S01 S02 S03 S04", oracle="""
SELECT o_orderstatus, COUNT(*) AS row_count, ROUND(SUM(o_totalprice), 2) AS total_price,
       MAX(o_orderkey) AS last_order, COUNT(o_orderdate) AS dated_orders FROM orders GROUP BY o_orderstatus
""")
def q_csv_roundtrip(spark, sf):
    base = _scratch(spark, "roundtrip")
    orders = IO.read_parquet(spark, os.path.join(sf, "orders.parquet"), name="orders")
    IO.write_csv(orders, base + ".csv")
    back = IO.read_csv(spark, base + ".csv", ORDERS_SCHEMA, name="orders csv")
    IO.write_parquet(back, base + ".parquet")
    again = IO.load_table(spark, base + ".parquet")
    return again.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"),
                                              F.round(F.sum("o_totalprice"), 2).alias("total_price"),
                                              F.max("o_orderkey").alias("last_order"),
                                              F.count("o_orderdate").alias("dated_orders"))


@register("csv_quoted_text", "S01", oracle="""
SELECT doc_id, md5(coalesce(nullif(text, ''), 'null')) AS text_md5, lang, n_chars FROM documents
""")
def q_csv_quoted_text(spark, sf):
    # texts with line breaks, quotes, commas and blanks at their ends, through CSV and back
    path = _scratch(spark, "quoted.csv")
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    IO.write_csv(documents, path)
    back = IO.read_csv(spark, path, documents.schema, malformed="fail", name="documents csv")
    return back.select("doc_id", F.md5(F.coalesce("text", F.lit("null"))).alias("text_md5"), "lang", "n_chars")


@register("file_order_numbers", "P18 N04 S03", oracle="""
SELECT o_orderkey, o_orderstatus, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS row_number
FROM orders WHERE o_orderstatus <> 'P'
""")
def q_file_order_numbers(spark, sf):
    # the orders in ten files, each larger than the one before: Spark reads the largest first
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    last = orders.agg(F.max("o_orderkey")).scalar()
    part = F.floor(F.sqrt(F.col("o_orderkey") / last) * 9.999).cast("int")
    path = _scratch(spark, "many-files")
    orders.withColumn("part", part).repartition("part").sortWithinPartitions("part", "o_orderkey").write.partitionBy(
        "part").parquet(path)
    kept = spark.read.parquet(path).filter("o_orderstatus <> 'P'").drop("part")
    return with_row_number(kept)


@register("sql_utilities", "S05 S06 S07 S08", oracle="""
SELECT c_mktsegment AS segment, COUNT(*) AS customers, ROUND(AVG(c_acctbal), 2) AS average_balance,
       3 AS registered_objects
FROM customer WHERE c_acctbal > 1000 AND c_nationkey <> 7 GROUP BY c_mktsegment
""")
def q_sql_utilities(spark, sf):
    IO.write_table(table(spark, sf, "customer"), "strata_customers", temporary=True)
    IO.execute_script(spark, """
        -- views over the registered table
        CREATE OR REPLACE TEMP VIEW strata_rich AS SELECT * FROM strata_customers WHERE c_acctbal > 1000;
        CREATE OR REPLACE TEMP VIEW strata_segments AS
            SELECT c_mktsegment AS segment, c_acctbal, c_nationkey FROM strata_rich;
    """)
    objects = IO.list_objects(spark).filter(F.col("name").startswith("strata_")).count()
    out = IO.query(spark, "SELECT segment, COUNT(*) AS customers, ROUND(AVG(c_acctbal), 2) AS average_balance "
                          "FROM strata_segments WHERE c_nationkey <> ? GROUP BY segment", [7])
    return out.withColumn("registered_objects", F.lit(objects))


def _orders_nulled(spark, sf):
    return table(spark, sf, "orders").withColumns({
        "o_orderstatus": F.nullif("o_orderstatus", F.lit("P")),
        "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW"))})


_REPORT_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
                 "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


@register("quality_report", "V07 V09 V10 V11 V13 V05 V06", oracle=f"""
WITH t AS (SELECT * REPLACE (NULLIF(o_orderstatus, 'P') AS o_orderstatus,
                             NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders),
n AS (SELECT COUNT(*) AS n FROM t),
m AS ({" UNION ALL ".join(f"SELECT '{c}' AS {chr(34)}column{chr(34)}, COUNT(*) - COUNT({c}) AS c FROM t" for c in _REPORT_TYPES)})
SELECT 'shape' AS section, '*' AS "column", 'rows' AS metric, CAST(n AS VARCHAR) AS value FROM n
UNION ALL SELECT 'shape', '*', 'columns', '{len(_REPORT_TYPES)}'
UNION ALL SELECT 'missing', "column", 'missing_count', CAST(c AS VARCHAR) FROM m WHERE c > 0
UNION ALL SELECT 'missing', "column", 'missing_percent', CAST(ROUND(100.0 * c / (SELECT n FROM n), 2) AS VARCHAR)
          FROM m WHERE c > 0
UNION ALL SELECT 'duplicates', '*', 'duplicate_rows',
          CAST((SELECT n FROM n) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM t)) AS VARCHAR)
UNION ALL SELECT 'duplicates', 'o_orderkey', 'duplicated_ids',
          CAST((SELECT COUNT(*) FROM (SELECT o_orderkey FROM t GROUP BY o_orderkey HAVING COUNT(*) > 1)) AS VARCHAR)
{" ".join(f"UNION ALL SELECT 'types', '{c}', 'dtype', '{k}'" for c, k in _REPORT_TYPES.items())}
{" ".join(f"UNION ALL SELECT 'types', '{c}', 'distinct_count', CAST(COUNT(DISTINCT {c}) AS VARCHAR) FROM t" for c in _REPORT_TYPES)}
UNION ALL SELECT DISTINCT 'unexpected', 'o_orderstatus', 'value', o_orderstatus FROM t
          WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F')
UNION ALL SELECT 'ranges', '*', 'key_above_10000', CAST(SUM(CASE WHEN o_orderkey > 10000 THEN 1 ELSE 0 END) AS VARCHAR)
          FROM t
""")
def q_quality_report(spark, sf):
    return Q.quality_report(_orders_nulled(spark, sf), id_column="o_orderkey", expected={"o_orderstatus": ["F"]},
                            ranges={"key_above_10000": F.col("o_orderkey") > 10000})


@register("preparation_summary", "V14", oracle="""
SELECT (SELECT COUNT(*) FROM part) AS raw_rows, 6 AS raw_columns,
       (SELECT COUNT(*) FROM part) AS processed_rows, 8 AS processed_columns,
       'name_prefix,price_log' AS added_columns
""")
def q_preparation_summary(spark, sf):
    from strata.functions import exprs as X
    raw = table(spark, sf, "part")
    processed = raw.withColumns({"name_prefix": X.token_prefix("p_name"), "price_log": X.log1p("p_retailprice")})
    out = Q.preparation_summary(raw, processed)
    return out.withColumn("added_columns", F.array_join("added_columns", ","))


@register("label_checks", "V16", oracle="""
SELECT COUNT(*) AS rows, SUM(CASE WHEN quality IS NULL THEN 1 ELSE 0 END)::BIGINT AS null_labels,
       COUNT(DISTINCT quality) AS classes FROM labels
""")
def q_label_checks(spark, sf):
    labels = table(spark, sf, "labels")
    Q.assert_trainable(labels, "quality", ["toxic"])
    return Q.label_checks(labels, "quality")


@register("saved_table_modes", "S05", oracle="""
SELECT c_mktsegment, 2 * COUNT(*) AS customers, 2 * SUM(c_custkey)::BIGINT AS keys, true AS second_create_refused FROM customer
GROUP BY c_mktsegment
""")
def q_saved_table_modes(spark, sf):
    # replaced once, appended to once; a table that is there is not created again
    name, path = f"saved_customers_{uuid.uuid4().hex}", _scratch(spark, "saved-table")
    customers = table(spark, sf, "customer")
    IO.write_table(customers.filter("c_custkey % 2 = 0"), name, "fail", path=path)
    IO.write_table(customers, name, "replace", path=path)
    IO.write_table(customers, name, "append")
    try:
        IO.write_table(customers, name, "fail")
        refused = False
    except AnalysisException:
        refused = True
    saved = spark.table(name)
    return saved.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), F.sum("c_custkey").alias("keys"),
                                             F.lit(refused).alias("second_create_refused"))


@register("required_columns", "V01", oracle="""
SELECT COUNT(*) AS rows, 'orders is missing required columns: absent_one, absent_two' AS message FROM orders
""")
def q_required_columns(spark, sf):
    orders = table(spark, sf, "orders")
    Q.require_columns(orders, orders.columns[:3], "orders")
    try:
        Q.require_columns(orders, ["absent_two", "o_orderkey", "absent_one"], "orders")
        message = None
    except ValueError as refused:
        message = str(refused)
    return orders.agg(F.count(F.lit(1)).alias("rows"), F.lit(message).alias("message"))


@register("null_order", "O07", oracle="""
WITH t AS (SELECT o_orderkey, NULLIF(o_orderpriority, '1-URGENT') AS priority FROM orders)
SELECT 'first' AS nulls, * FROM (SELECT * FROM t ORDER BY priority ASC NULLS FIRST, o_orderkey LIMIT 25)
UNION ALL SELECT 'last', * FROM (SELECT * FROM t ORDER BY priority DESC NULLS LAST, o_orderkey DESC LIMIT 25)
""")
def q_null_order(spark, sf):
    t = table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"))
    first = C.top_k(t, [F.col("priority").asc_nulls_first(), F.col("o_orderkey")], 25)
    last = C.top_k(t, [F.col("priority").desc_nulls_last(), F.col("o_orderkey").desc()], 25)
    return first.select(F.lit("first").alias("nulls"), "*").unionByName(last.select(F.lit("last").alias("nulls"), "*"))


@register("strict_types", "V02 V03", oracle="""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
""")
def q_strict_types(spark, sf):
    # everything as text, some integers with a fraction of zero, back to types by the strict path
    orders = table(spark, sf, "orders")
    texts = orders.select(
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")))
        .otherwise(F.col("o_orderkey").cast("string")).alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"), F.col("o_totalprice").cast("string").alias("o_totalprice"),
        "o_orderpriority")
    return Q.standardize_types(texts, strings=["o_orderpriority"], doubles=["o_totalprice"], integers=["o_orderkey", "o_custkey"])
