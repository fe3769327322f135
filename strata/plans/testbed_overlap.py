"""Harmonization, text keys and overlap-audit queries on the driver tables.

External source for harmonization: customers re-expressed in the external
column layout. Overlap: odd document ids are the external side, even ids
the training side; the name key is the normalized text (exact and near
copies match), the ticket key is the code key of ``source n_chars``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.functions.text import code_key, name_key
from strata.operators import harmonize as H
from strata.operators import overlap as O
from strata.plans.registry import register, table

CLASS_CODES = {"automobile": 1, "building": 2, "furniture": 3}
SPEC = H.ExternalSpec(class_codes=CLASS_CODES)

_EXTERNAL_SQL = """(SELECT c_custkey,
    c_name AS name,
    CASE WHEN c_custkey % 2 = 0 THEN ' Male ' ELSE 'female' END AS gender,
    CASE WHEN c_custkey % 7 = 0 THEN 'unknown' ELSE CAST(c_nationkey + 20 AS VARCHAR) END AS age,
    c_mktsegment AS "class",
    CASE c_nationkey % 5 WHEN 0 THEN 'Southampton' WHEN 1 THEN 'cherbourg ' WHEN 2 THEN 'Q'
         WHEN 3 THEN NULL ELSE 'x-port' END AS embarked,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'PC  ' || CAST(c_custkey % 50 AS VARCHAR) END AS ticketno,
    CAST(c_acctbal AS VARCHAR) AS fare,
    CAST(c_nationkey % 3 AS VARCHAR) AS sibsp,
    '0' AS parch,
    CASE WHEN c_acctbal > 5000 THEN 'yes' ELSE ' No' END AS survived,
    'NATION_' || CAST(c_nationkey AS VARCHAR) AS country
  FROM customer)"""


def external_source(spark, sf):
    c = table(spark, sf, "customer")
    key, nat = F.col("c_custkey"), F.col("c_nationkey")
    return c.select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.when(key % 2 == 0, " Male ").otherwise("female").alias("gender"),
        F.when(key % 7 == 0, "unknown").otherwise((nat + 20).cast("string")).alias("age"),
        F.col("c_mktsegment").alias("class"),
        F.when(nat % 5 == 0, "Southampton").when(nat % 5 == 1, "cherbourg ").when(nat % 5 == 2, "Q")
        .when(nat % 5 == 3, F.lit(None)).otherwise("x-port").alias("embarked"),
        F.when(key % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("PC  "), (key % 50).cast("string"))).alias("ticketno"),
        F.col("c_acctbal").cast("string").alias("fare"),
        (nat % 3).cast("string").alias("sibsp"),
        F.lit("0").alias("parch"),
        F.when(F.col("c_acctbal") > 5000, "yes").otherwise(" No").alias("survived"),
        F.concat(F.lit("NATION_"), nat.cast("string")).alias("country"),
    )


_HARMONIZED_SQL = f"""
WITH src AS {_EXTERNAL_SQL},
kept AS (SELECT *, ROW_NUMBER() OVER (ORDER BY c_custkey) AS rn FROM src
         WHERE lower(trim("class")) IN ('automobile', 'building', 'furniture'))
SELECT rn AS PassengerId,
       CASE lower(trim(survived)) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END::BIGINT AS Survived,
       CASE lower(trim("class")) WHEN 'automobile' THEN 1 WHEN 'building' THEN 2 WHEN 'furniture' THEN 3 END::BIGINT
           AS Pclass,
       trim(regexp_replace(coalesce(name, ''), '\\s+', ' ', 'g')) AS Name,
       lower(trim(gender)) AS Sex,
       TRY_CAST(age AS DOUBLE) AS Age,
       CAST(sibsp AS BIGINT) AS SibSp, CAST(parch AS BIGINT) AS Parch,
       NULLIF(trim(regexp_replace(coalesce(ticketno, ''), '\\s+', ' ', 'g')), '') AS Ticket,
       TRY_CAST(fare AS DOUBLE) AS Fare,
       CAST(NULL AS VARCHAR) AS Cabin,
       CASE WHEN embarked IS NULL OR trim(embarked) = '' THEN NULL
            WHEN lower(trim(embarked)) = 'southampton' THEN 'S' WHEN lower(trim(embarked)) = 'cherbourg' THEN 'C'
            WHEN lower(trim(embarked)) = 'queenstown' THEN 'Q' WHEN lower(trim(embarked)) = 'belfast' THEN 'B'
            WHEN upper(left(trim(embarked), 1)) IN ('B', 'C', 'Q', 'S') THEN upper(left(trim(embarked), 1))
            ELSE upper(trim(embarked)) END AS Embarked,
       NULLIF(trim(country), '') AS Country,
       rn AS ExternalSourceRow
FROM kept
"""


@register("harmonize", "H02 F13 F17 F18 F19 F20 V03 V04 V17 P14 P15 P18 N04", oracle=_HARMONIZED_SQL)
def q_harmonize(spark, sf):
    return H.harmonize_external(external_source(spark, sf).drop("c_custkey"), SPEC)


@register("class_filter_summary", "A27 P15", oracle=f"""
WITH src AS {_EXTERNAL_SQL},
c AS (SELECT COALESCE(lower(trim("class")), 'missing') AS cls,
             CASE lower(trim("class")) WHEN 'automobile' THEN 1 WHEN 'building' THEN 2 WHEN 'furniture' THEN 3 END
                 AS code FROM src)
SELECT 'source_rows' AS metric, '' AS key, COUNT(*)::BIGINT AS value FROM c
UNION ALL SELECT 'retained_rows', '', COUNT(code)::BIGINT FROM c
UNION ALL SELECT 'excluded_rows', '', (COUNT(*) - COUNT(code))::BIGINT FROM c
UNION ALL SELECT 'retained_class_rows', CAST(code AS VARCHAR), COUNT(*)::BIGINT FROM c WHERE code IS NOT NULL GROUP BY code
UNION ALL SELECT 'excluded_class_rows', cls, COUNT(*)::BIGINT FROM c WHERE code IS NULL GROUP BY cls
""")
def q_class_filter_summary(spark, sf):
    return H.class_filter_summary(external_source(spark, sf), SPEC)


def _ws(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '\\s+', ' ', 'g'))"


def _name_key_sql(x: str) -> str:
    ws = _ws(x)
    return (f"CASE WHEN {ws} = '' THEN '' ELSE trim(regexp_replace(regexp_replace(lower(strip_accents({ws})), "
            f"'[^a-z0-9]+', ' ', 'g'), '\\s+', ' ', 'g')) END")


def _code_key_sql(x: str) -> str:
    ws = _ws(x)
    return f"CASE WHEN {ws} = '' THEN '' ELSE regexp_replace(upper(strip_accents({ws})), '[^A-Z0-9]', '', 'g') END"


@register("text_keys", "F13 F14 F15 F16", oracle=f"""
SELECT doc_id, md5({_name_key_sql('text')}) AS name_key_md5,
       {_code_key_sql("source || ' ' || CAST(n_chars AS VARCHAR)")} AS code_key,
       length({_ws('text')}) AS normalized_length
FROM documents
""")
def q_text_keys(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.md5(name_key("text")).alias("name_key_md5"),
                    code_key(F.concat_ws(" ", "source", F.col("n_chars").cast("string"))).alias("code_key"),
                    F.length(X.normalize_whitespace("text")).alias("normalized_length"))


def _sides(spark, sf):
    d = table(spark, sf, "documents").select(
        F.col("doc_id").alias("PassengerId"), F.col("text").alias("Name"),
        F.concat_ws(" ", "source", F.col("n_chars").cast("string")).alias("Ticket"), "lang")
    return d.filter(F.col("PassengerId") % 2 == 1), d.filter(F.col("PassengerId") % 2 == 0)


_AUDIT_SQL = f"""
WITH ext AS (SELECT doc_id AS PassengerId, {_name_key_sql('text')} AS nk,
                    {_code_key_sql("source || ' ' || CAST(n_chars AS VARCHAR)")} AS tk, lang
             FROM documents WHERE doc_id % 2 = 1),
tr AS (SELECT doc_id AS TrainingId, {_name_key_sql('text')} AS nk,
              {_code_key_sql("source || ' ' || CAST(n_chars AS VARCHAR)")} AS tk
       FROM documents WHERE doc_id % 2 = 0),
nl AS (SELECT nk, COUNT(*) AS n FROM tr WHERE nk <> '' GROUP BY nk),
tl AS (SELECT tk, COUNT(*) AS n FROM tr WHERE tk <> '' GROUP BY tk),
audit AS (
  SELECT e.PassengerId, e.lang, nl.n IS NOT NULL AS NameMatch, tl.n IS NOT NULL AS TicketMatch,
         COALESCE(nl.n, 0)::BIGINT AS NameMatchCount, COALESCE(tl.n, 0)::BIGINT AS TicketMatchCount
  FROM ext e LEFT JOIN nl ON e.nk = nl.nk AND e.nk <> '' LEFT JOIN tl ON e.tk = tl.tk AND e.tk <> '')"""


@register("overlap_audit", "H03 H04 J03 J05", oracle=_AUDIT_SQL + """
SELECT PassengerId, NameMatch, TicketMatch, NameMatch AND TicketMatch AS NameAndTicketMatch,
       NameMatch OR TicketMatch AS NameOrTicketMatch, NameMatchCount, TicketMatchCount,
       CASE WHEN NameMatch AND TicketMatch THEN 'name_and_ticket' WHEN NameMatch THEN 'name_only'
            WHEN TicketMatch THEN 'ticket_only' ELSE 'none' END AS OverlapEvidence
FROM audit
""")
def q_overlap_audit(spark, sf):
    ext, tr = _sides(spark, sf)
    audit = O.audit_overlap(ext, tr)
    return audit.select("PassengerId", "NameMatch", "TicketMatch", "NameAndTicketMatch", "NameOrTicketMatch",
                        "NameMatchCount", "TicketMatchCount", "OverlapEvidence")


@register("match_lookup", "J04", oracle=f"""
SELECT nk AS NormalizedTicket, doc_id AS TrainingId, COUNT(*) OVER (PARTITION BY nk) AS match_count
FROM (SELECT doc_id, {_code_key_sql("source || ' ' || CAST(n_chars AS VARCHAR)")} AS nk
      FROM documents WHERE doc_id % 2 = 0) WHERE nk <> ''
""")
def q_match_lookup(spark, sf):
    _, tr = _sides(spark, sf)
    keys = O.training_match_keys(tr, "Name", "Ticket", "PassengerId")
    return O.match_lookup(keys, "NormalizedTicket")


@register("match_id_lists", "J04 F28", oracle=f"""
SELECT nk AS NormalizedName, COUNT(*) AS match_count, 0::BIGINT AS chunk,
       '[' || array_to_string(list_sort(list(doc_id)), ', ') || ']' AS matched_ids
FROM (SELECT doc_id, {_name_key_sql('text')} AS nk FROM documents WHERE doc_id % 2 = 0) WHERE nk <> ''
GROUP BY nk
""")
def q_match_id_lists(spark, sf):
    _, tr = _sides(spark, sf)
    keys = O.training_match_keys(tr, "Name", "Ticket", "PassengerId")
    lists = O.match_id_lists(keys, "NormalizedName", ids_per_row=10_000)
    return lists.withColumn("matched_ids", X.ids_json("matched_ids"))


@register("match_id_chunks", "J04 F28", oracle="""
WITH ranked AS (SELECT lang, doc_id, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS r,
                       COUNT(*) OVER (PARTITION BY lang) AS n FROM documents WHERE lang <> '')
SELECT lower(lang) AS NormalizedName, MAX(n) AS match_count, (r // 64)::BIGINT AS chunk,
       '[' || array_to_string(list_sort(list(doc_id)), ', ') || ']' AS matched_ids
FROM ranked GROUP BY lang, r // 64
""")
def q_match_id_chunks(spark, sf):
    # few hot keys: every key's ids are spread over many rows of at most 64
    keys = O.training_match_keys(table(spark, sf, "documents"), "lang", "source", "doc_id")
    return O.match_id_lists(keys, "NormalizedName", ids_per_row=64).withColumn("matched_ids", X.ids_json("matched_ids"))


@register("nonoverlap", "J06 H05", oracle=_AUDIT_SQL + """
SELECT PassengerId, lang FROM audit WHERE NOT (NameMatch OR TicketMatch)
""")
def q_nonoverlap(spark, sf):
    ext, tr = _sides(spark, sf)
    kept = O.nonoverlap(O.audit_overlap(ext, tr), "either")
    return kept.select("PassengerId", "lang")


@register("nonoverlap_both", "J06", oracle=_AUDIT_SQL + """
SELECT PassengerId, lang FROM audit WHERE NOT (NameMatch AND TicketMatch)
""")
def q_nonoverlap_both(spark, sf):
    ext, tr = _sides(spark, sf)
    return O.nonoverlap(O.audit_overlap(ext, tr), "both").select("PassengerId", "lang")


@register("overlap_summary", "A27 H05", oracle=_AUDIT_SQL + """
SELECT COUNT(*) AS external_rows, (SELECT COUNT(*) FROM documents WHERE doc_id % 2 = 0)::BIGINT AS training_rows,
       SUM(NameMatch::INT)::BIGINT AS name_matches, SUM(TicketMatch::INT)::BIGINT AS ticket_matches,
       SUM((NameMatch AND TicketMatch)::INT)::BIGINT AS both_matches,
       SUM((NameMatch OR TicketMatch)::INT)::BIGINT AS either_matches,
       SUM((NOT (NameMatch OR TicketMatch))::INT)::BIGINT AS nonoverlap_rows,
       ROUND(100.0 * AVG((NOT (NameMatch OR TicketMatch))::INT), 2) AS nonoverlap_percent
FROM audit
""")
def q_overlap_summary(spark, sf):
    ext, tr = _sides(spark, sf)
    audit = O.audit_overlap(ext, tr)
    n_train = tr.agg(F.count(F.lit(1))).scalar()
    return O.overlap_summary(audit, n_train)


@register("overlap_class_counts", "A27", oracle=_AUDIT_SQL + """
SELECT lang, COUNT(*) AS rows_before, SUM((NOT (NameMatch OR TicketMatch))::INT)::BIGINT AS rows_after
FROM audit GROUP BY lang
""")
def q_overlap_class_counts(spark, sf):
    ext, tr = _sides(spark, sf)
    return O.class_counts_before_after(O.audit_overlap(ext, tr), "either", "lang")


def _external_sql() -> str:
    from strata.plans.testbed_passenger import _PASSENGERS_SQL
    trained = f"SELECT {_name_key_sql('Name')} AS nk, {_code_key_sql('Ticket')} AS tk FROM ({_PASSENGERS_SQL} SELECT * FROM p)"
    return f"""
WITH clean AS ({_HARMONIZED_SQL}), trained AS ({trained}),
keyed AS (SELECT *, {_name_key_sql('Name')} AS nk, {_code_key_sql('Ticket')} AS tk FROM clean)
SELECT * EXCLUDE (nk, tk) FROM keyed
WHERE NOT (nk <> '' AND nk IN (SELECT nk FROM trained)) AND NOT (tk <> '' AND tk IN (SELECT tk FROM trained))"""


@register("external_preparation", "H05 S20 A27 J06", oracle=_external_sql())
def q_external_preparation(spark, sf):
    from strata.plans.external import prepare_external
    from strata.plans.testbed_passenger import passengers
    # customers in the external layout vs the passenger-shaped training table
    training = passengers(spark, sf).select("PassengerId", "Name", "Ticket")
    run = prepare_external(external_source(spark, sf).drop("c_custkey"), training, rule="either", spec=SPEC)
    return run.nonoverlap
