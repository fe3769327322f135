"""Cohort query shapes (the 20 named analyses and 4 views) mapped onto the
driver's TPC-H-like tables. Each builder reads whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators import cohort as C
from strata.plans.registry import register, table

PRIORITY_ORDER = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@register("overview", "Q01 A01 A04 A06 A07 P04", oracle="""
SELECT COUNT(*) AS row_count,
       COUNT(DISTINCT o_orderkey) AS unique_ids,
       COUNT(DISTINCT o_orderpriority) AS distinct_classes,
       ROUND(100.0 * AVG(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 2) AS positive_rate_percent,
       CAST(SUM(CASE WHEN NULLIF(o_orderstatus, 'P') IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_status_count,
       CAST(SUM(CASE WHEN NULLIF(o_orderpriority, '5-LOW') IS NULL
                      OR TRIM(NULLIF(o_orderpriority, '5-LOW')) = '' THEN 1 ELSE 0 END) AS BIGINT)
           AS missing_priority_count
FROM orders
""")
def q_overview(spark, sf):
    o = table(spark, sf, "orders")
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    prio = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return C.overview(o, {
        "row_count": F.count(F.lit(1)),
        "unique_ids": F.count_distinct("o_orderkey"),
        "distinct_classes": F.count_distinct("o_orderpriority"),
        "positive_rate_percent": X.rate_pct(X.equals_flag("o_orderstatus", "F")),
        "missing_status_count": X.count_when(status.isNull()),
        "missing_priority_count": X.count_when(X.sql_blank(prio)),
    })


@register("share_of_total", "Q02 N01 A02", oracle="""
SELECT o_orderpriority AS priority,
       COUNT(*) AS row_count,
       ROUND(100.0 * CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), 2) AS share_percent
FROM orders GROUP BY o_orderpriority
""")
def q_share_of_total(spark, sf):
    o = table(spark, sf, "orders")
    return C.share_of_total(o, F.col("o_orderpriority").alias("priority"))


@register("share_within", "W2 Q07 N02 P04", oracle="""
SELECT NULLIF(o_orderpriority, '5-LOW') AS priority, o_orderstatus AS status,
       COUNT(*) AS row_count,
       ROUND(100.0 * CAST(COUNT(*) AS DOUBLE)
             / SUM(COUNT(*)) OVER (PARTITION BY NULLIF(o_orderpriority, '5-LOW')), 2) AS share_within_percent
FROM orders WHERE NULLIF(o_orderpriority, '5-LOW') IS NOT NULL
GROUP BY NULLIF(o_orderpriority, '5-LOW'), o_orderstatus
""")
def q_share_within(spark, sf):
    o = table(spark, sf, "orders")
    return C.share_within(o, F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
                          F.col("o_orderstatus").alias("status"))


@register("group_profile", "W1 W3 W4 Q10 Q11 Q19 A02 A07 A14", oracle="""
SELECT l_returnflag AS return_flag, l_linestatus AS line_status,
       COUNT(*) AS row_count,
       ROUND(AVG(l_quantity), 2) AS average_quantity,
       ROUND(AVG(l_extendedprice), 2) AS average_price,
       ROUND(AVG(l_discount), 3) AS average_discount,
       ROUND(100.0 * AVG(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END), 2) AS percent_high_tax
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def q_group_profile(spark, sf):
    li = table(spark, sf, "lineitem")
    return C.group_profile(
        li, [F.col("l_returnflag").alias("return_flag"), F.col("l_linestatus").alias("line_status")],
        {"average_quantity": X.rounded_avg("l_quantity"),
         "average_price": X.rounded_avg("l_extendedprice"),
         "average_discount": X.rounded_avg("l_discount", 3),
         "percent_high_tax": X.rate_pct((F.col("l_tax") > 0.04).cast("int"))})


@register("group_profile_expr", "Q08 A03 P13 O04", oracle="""
SELECT COALESCE(NULLIF(event_type, 'error'), 'Unknown') AS event_kind,
       COUNT(*) AS row_count,
       ROUND(AVG(value), 2) AS average_value,
       ROUND(AVG(user_id), 2) AS average_user,
       ROUND(100.0 * AVG(CASE WHEN value > 10 THEN 1 ELSE 0 END), 2) AS percent_large
FROM events GROUP BY COALESCE(NULLIF(event_type, 'error'), 'Unknown')
""")
def q_group_profile_expr(spark, sf):
    ev = table(spark, sf, "events")
    kind = X.coalesce_default(F.nullif(F.col("event_type"), F.lit("error")), "Unknown").alias("event_kind")
    return C.group_profile(
        ev, kind,
        {"average_value": X.rounded_avg("value"),
         "average_user": X.rounded_avg("user_id"),
         "percent_large": X.rate_pct((F.col("value") > 10).cast("int"))},
        order_by=[F.col("row_count").desc()])


@register("profile_join", "Q03 J01", oracle="""
WITH profile AS (
  SELECT c_mktsegment AS segment, COUNT(*) AS customer_count,
         ROUND(AVG(c_acctbal), 2) AS average_balance
  FROM customer GROUP BY c_mktsegment),
extra AS (
  SELECT c.c_mktsegment AS segment,
         ROUND(100.0 * AVG(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END), 2) AS percent_finished,
         ROUND(AVG(o.o_totalprice), 2) AS average_order_price
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment)
SELECT p.segment, p.customer_count, p.average_balance, e.percent_finished, e.average_order_price
FROM profile p JOIN extra e ON p.segment = e.segment
""")
def q_profile_join(spark, sf):
    cust = table(spark, sf, "customer")
    orders = table(spark, sf, "orders")
    profile = C.group_profile(cust, F.col("c_mktsegment").alias("segment"),
                              {"average_balance": X.rounded_avg("c_acctbal")}, count_name="customer_count")
    # order facts pre-aggregated per customer before meeting the customer table
    extra = C.averages_through_join(orders, "o_custkey", cust, "c_custkey", "c_mktsegment", {
        "percent_finished": (X.equals_flag("o_orderstatus", "F").cast("double"), 100.0, 2),
        "average_order_price": (F.col("o_totalprice"), 1.0, 2),
    }, group_name="segment")
    return profile.join(extra, "segment")


@register("outcome_rate", "Q04 A10 J02", oracle="""
SELECT d.lang AS lang, l.quality AS quality,
       COUNT(*) AS row_count,
       CAST(SUM(l.toxic) AS BIGINT) AS positive_count,
       CAST(COUNT(*) - SUM(l.toxic) AS BIGINT) AS negative_count,
       ROUND(100.0 * AVG(l.toxic), 2) AS positive_rate_percent
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
GROUP BY d.lang, l.quality
""")
def q_outcome_rate(spark, sf):
    labels = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    joined = labels.join(docs, "doc_id")
    return C.outcome_rate(joined, ["lang", "quality"], "toxic")


@register("numeric_stats", "Q05 A05 A09", oracle="""
SELECT l_returnflag AS return_flag,
       COUNT(l_extendedprice) AS value_count,
       ROUND(MIN(l_extendedprice), 2) AS value_min,
       ROUND(AVG(l_extendedprice), 2) AS value_avg,
       ROUND(MAX(l_extendedprice), 2) AS value_max,
       ROUND(VAR_POP(l_extendedprice), 2) AS value_variance
FROM lineitem GROUP BY l_returnflag
""")
def q_numeric_stats(spark, sf):
    li = table(spark, sf, "lineitem")
    return C.numeric_stats(li, F.col("l_returnflag").alias("return_flag"), "l_extendedprice")


@register("banded_profile", "Q06 A06 P12", oracle="""
SELECT lang,
       COUNT(*) AS row_count,
       COUNT(NULLIF(n_chars, 1000)) AS value_known_count,
       CAST(SUM(CASE WHEN NULLIF(n_chars, 1000) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS value_missing_count,
       ROUND(AVG(NULLIF(n_chars, 1000)), 2) AS value_avg,
       ROUND(MIN(NULLIF(n_chars, 1000)), 2) AS value_min,
       ROUND(MAX(NULLIF(n_chars, 1000)), 2) AS value_max,
       CAST(SUM(CASE WHEN NULLIF(n_chars, 1000) < 500 THEN 1 ELSE 0 END) AS BIGINT) AS short_count,
       CAST(SUM(CASE WHEN NULLIF(n_chars, 1000) >= 500 AND NULLIF(n_chars, 1000) < 5000 THEN 1 ELSE 0 END) AS BIGINT)
           AS medium_count,
       CAST(SUM(CASE WHEN NULLIF(n_chars, 1000) >= 5000 THEN 1 ELSE 0 END) AS BIGINT) AS long_count
FROM documents GROUP BY lang
""")
def q_banded_profile(spark, sf):
    docs = table(spark, sf, "documents").select("lang", F.nullif(F.col("n_chars"), F.lit(1000)).alias("n"))
    return C.banded_profile(docs, "lang", "n", [("short_count", None, 500), ("medium_count", 500, 5000),
                                                ("long_count", 5000, None)])


@register("ordered_by_list", "Q09 O02 W3", oracle="""
SELECT o_orderpriority AS priority, o_orderstatus AS status,
       COUNT(*) AS row_count, ROUND(AVG(o_totalprice), 2) AS average_price
FROM orders GROUP BY o_orderpriority, o_orderstatus
""")
def q_ordered_by_list(spark, sf):
    o = table(spark, sf, "orders")
    prof = C.group_profile(o, [F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")],
                           {"average_price": X.rounded_avg("o_totalprice")})
    return C.order_by_list(prof, "priority", PRIORITY_ORDER, "status")


@register("cabin_style_profile", "Q12 O03 P12", oracle="""
SELECT CASE WHEN o_orderstatus = 'F' THEN 'Finished' ELSE 'Not finished' END AS status_label,
       COUNT(*) AS row_count, ROUND(AVG(o_totalprice), 2) AS average_price
FROM orders GROUP BY CASE WHEN o_orderstatus = 'F' THEN 'Finished' ELSE 'Not finished' END
""")
def q_cabin_style(spark, sf):
    # Group by the raw 0/1 flag, relabel it, order by the (non-projected) flag.
    o = table(spark, sf, "orders").withColumn("flag", X.equals_flag("o_orderstatus", "F"))
    prof = C.group_profile(o, "flag", {"average_price": X.rounded_avg("o_totalprice")})
    label = F.when(F.col("flag") == 1, "Finished").otherwise("Not finished").alias("status_label")
    return prof.orderBy(F.col("flag").desc()).select(label, "row_count", "average_price")


@register("label_profile", "Q13 F05 O01", oracle="""
SELECT CASE WHEN array_length(string_split_regex(trim(upper(p_name)), '\\s+')) <= 1 THEN 'NONE'
            ELSE array_to_string(string_split_regex(trim(upper(p_name)), '\\s+')[1:-2], '_') END AS name_prefix,
       COUNT(*) AS row_count,
       ROUND(AVG(p_size), 2) AS average_size,
       ROUND(AVG(p_retailprice), 2) AS average_price
FROM part GROUP BY 1
""")
def q_label_profile(spark, sf):
    part = table(spark, sf, "part")
    return C.group_profile(part, X.token_prefix("p_name").alias("name_prefix"),
                           {"average_size": X.rounded_avg("p_size"), "average_price": X.rounded_avg("p_retailprice")},
                           order_by=[F.col("row_count").desc(), F.col("name_prefix")])


@register("top_groups", "Q14 A12 O05", oracle="""
SELECT p_brand AS brand, COUNT(*) AS row_count,
       ROUND(AVG(p_size), 2) AS average_size, ROUND(AVG(p_retailprice), 2) AS average_price
FROM part GROUP BY p_brand HAVING COUNT(*) >= 3
ORDER BY row_count DESC, brand LIMIT 20
""")
def q_top_groups(spark, sf):
    part = table(spark, sf, "part")
    return C.group_profile(part, F.col("p_brand").alias("brand"),
                           {"average_size": X.rounded_avg("p_size"), "average_price": X.rounded_avg("p_retailprice")},
                           having=F.col("row_count") >= 3,
                           order_by=[F.col("row_count").desc(), F.col("brand")], limit=20)


@register("top_k", "Q15 O05 P01", oracle="""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       o_totalprice AS total_price, o_orderpriority AS priority
FROM orders WHERE o_totalprice IS NOT NULL
ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def q_top_k(spark, sf):
    o = table(spark, sf, "orders")
    return C.top_k(o, [F.col("total_price").desc(), F.col("order_id")], 20, not_null=["o_totalprice"],
                   columns=[F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                            F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total_price"),
                            F.col("o_orderpriority").alias("priority")])


@register("top_k_multi", "Q16 O01 O05", oracle="""
SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_quantity AS quantity,
       l_extendedprice AS price, l_returnflag AS return_flag
FROM lineitem ORDER BY l_quantity DESC, l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 25
""")
def q_top_k_multi(spark, sf):
    li = table(spark, sf, "lineitem")
    return C.top_k(li, [F.col("quantity").desc(), F.col("price").desc(), F.col("order_id"), F.col("line_number")], 25,
                   columns=[F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
                            F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
                            F.col("l_returnflag").alias("return_flag")])


@register("bottom_k", "O06 O05", oracle="""
SELECT o_orderkey AS order_id, o_totalprice AS total_price
FROM orders ORDER BY o_totalprice ASC, o_orderkey LIMIT 10
""")
def q_bottom_k(spark, sf):
    o = table(spark, sf, "orders")
    return C.top_k(o, [F.col("total_price").asc(), F.col("order_id")], 10,
                   columns=[F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total_price")])


@register("feature_summary", "Q17 A01", oracle="""
SELECT ROUND(AVG(l_quantity), 3) AS average_quantity,
       MIN(l_quantity) AS minimum_quantity, MAX(l_quantity) AS maximum_quantity,
       ROUND(100.0 * AVG(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 2) AS percent_returned,
       ROUND(AVG(ln(1 + l_discount)), 3) AS average_log_discount,
       ROUND(MIN(ln(1 + l_tax)), 3) AS minimum_log_tax,
       ROUND(MAX(ln(1 + l_tax)), 3) AS maximum_log_tax
FROM lineitem
""")
def q_feature_summary(spark, sf):
    li = table(spark, sf, "lineitem")
    return C.overview(li, {
        "average_quantity": X.rounded_avg("l_quantity", 3),
        "minimum_quantity": F.min("l_quantity"),
        "maximum_quantity": F.max("l_quantity"),
        "percent_returned": X.rate_pct(X.equals_flag("l_returnflag", "R")),
        "average_log_discount": F.round(F.avg(X.log1p("l_discount")), 3),
        "minimum_log_tax": F.round(F.min(X.log1p("l_tax")), 3),
        "maximum_log_tax": F.round(F.max(X.log1p("l_tax")), 3),
    })


@register("missing_by_group", "Q18 A08 A06", oracle="""
SELECT o_orderpriority AS priority, COUNT(*) AS row_count,
       CAST(SUM(CASE WHEN NULLIF(o_orderstatus, 'P') IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_status_count,
       ROUND(100.0 * CAST(SUM(CASE WHEN NULLIF(o_orderstatus, 'P') IS NULL THEN 1 ELSE 0 END) AS DOUBLE)
             / COUNT(*), 2) AS missing_status_percent,
       CAST(SUM(CASE WHEN NULLIF(o_orderstatus, 'O') IS NULL OR TRIM(NULLIF(o_orderstatus, 'O')) = ''
                THEN 1 ELSE 0 END) AS BIGINT) AS blank_status_count
FROM orders GROUP BY o_orderpriority
""")
def q_missing_by_group(spark, sf):
    o = table(spark, sf, "orders")
    return C.missing_by_group(o, F.col("o_orderpriority").alias("priority"), {
        "missing_status": (F.nullif(F.col("o_orderstatus"), F.lit("P")).isNull(), True),
        "blank_status": (X.sql_blank(F.nullif(F.col("o_orderstatus"), F.lit("O"))), False),
    })


@register("shared_keys", "Q20 A11 A25 A12", oracle="""
SELECT md5(text) AS shared_key, COUNT(*) AS row_count,
       COUNT(DISTINCT lang) AS distinct_categories,
       ROUND(AVG(n_chars), 2) AS average_value,
       array_to_string(list_sort(list(DISTINCT lang)), ',') AS categories
FROM documents WHERE md5(text) IS NOT NULL AND TRIM(md5(text)) <> ''
GROUP BY md5(text) HAVING COUNT(*) >= 2
ORDER BY row_count DESC, shared_key LIMIT 30
""")
def q_shared_keys(spark, sf):
    docs = table(spark, sf, "documents")
    return C.shared_keys(docs, F.md5(F.col("text")), "lang", "n_chars", k=30)
