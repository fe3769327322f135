"""Feature-extraction queries: text features on documents/pages, numeric
features and bins on lineitem, recodes and labels on part."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators import cohort as C
from strata.plans.registry import register, table

_STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
_TITLE_RE = ",\\s*([^.]*)\\."


def _strip(x: str) -> str:
    return _STRIP.format(x=x)


_TITLE_SQL = f"""CASE WHEN text IS NULL OR {_strip('text')} = '' THEN 'Unknown'
     WHEN NOT regexp_matches(text, '{_TITLE_RE}') THEN 'Unknown'
     ELSE (SELECT CASE WHEN t IN ('Capt', 'Col', 'Don', 'Dona', 'Dr', 'Jonkheer', 'Lady', 'Major', 'Rev', 'Sir',
                                  'the Countess') THEN 'Rare' ELSE t END
           FROM (SELECT CASE r WHEN 'Mlle' THEN 'Miss' WHEN 'Ms' THEN 'Miss' WHEN 'Mme' THEN 'Mrs' ELSE r END AS t
                 FROM (SELECT {_strip(f"regexp_extract(text, '{_TITLE_RE}', 1)")} AS r))) END"""


@register("title_surname", "F01 F02 F30", oracle=f"""
SELECT doc_id, {_TITLE_SQL} AS title,
       CASE WHEN text IS NULL OR {_strip('text')} = '' OR {_strip("split_part(text, ',', 1)")} = '' THEN 'Unknown'
            ELSE {_strip("split_part(text, ',', 1)")} END AS surname,
       CASE WHEN regexp_matches(text, ',\\s*([^\\.]+)\\.') THEN regexp_extract(text, ',\\s*([^\\.]+)\\.', 1) END
           AS raw_title
FROM documents
""")
def q_title_surname(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.extract_title("text").alias("title"), X.extract_surname("text").alias("surname"),
                    X.notebook_title("text").alias("raw_title"))


@register("text_shape", "F03 F04 F10 F30", oracle=f"""
SELECT doc_id,
       CASE WHEN text IS NULL OR {_strip('text')} = '' THEN 'Unknown'
            WHEN regexp_matches(upper(left({_strip('text')}, 1)), '^\\p{{L}}+$') THEN upper(left({_strip('text')}, 1))
            ELSE 'Unknown' END AS first_letter,
       CASE WHEN text IS NULL OR {_strip('text')} = '' THEN 0
            ELSE len(string_split_regex({_strip('text')}, '\\s+')) END::BIGINT AS token_count,
       CASE WHEN NULLIF(lang, 'en') IS NOT NULL THEN 1 ELSE 0 END AS has_lang,
       left(COALESCE(NULLIF(lang, 'en'), 'Unknown'), 1) AS lang_initial
FROM documents
""")
def q_text_shape(spark, sf):
    d = table(spark, sf, "documents")
    lang = F.nullif(F.col("lang"), F.lit("en"))
    return d.select("doc_id", X.first_letter("text").alias("first_letter"), X.token_count("text").alias("token_count"),
                    X.presence_flag(lang).alias("has_lang"), X.notebook_deck(lang).alias("lang_initial"))


@register("token_prefix", "F05 F21", oracle="""
WITH u AS (SELECT page_id, url,
                  trim(replace(replace(upper(url), '.', ''), '/', ' ')) AS cleaned FROM pages)
SELECT page_id,
       CASE WHEN url IS NULL OR trim(url) = '' THEN 'Unknown'
            WHEN cleaned = '' OR len(string_split_regex(cleaned, '\\s+')) <= 1 THEN 'NONE'
            ELSE array_to_string(string_split_regex(cleaned, '\\s+')[1:-2], '_') END AS url_prefix,
       COALESCE(NULLIF(regexp_extract(regexp_replace(url, '[./]', '', 'g'), '([A-Za-z]+)', 1), ''), 'NONE')
           AS letters_prefix
FROM u
""")
def q_token_prefix(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", X.token_prefix("url").alias("url_prefix"), X.letters_prefix("url").alias("letters_prefix"))


@register("numeric_features", "F06 F07 F08 F09 F11 F22 P17 A02", oracle="""
WITH f AS (
  SELECT CAST(1 + COALESCE(TRY_CAST(NULLIF(l_linenumber - 1, 0) AS DOUBLE), 0)
              + COALESCE(TRY_CAST(CAST(FLOOR(l_quantity / 10) AS VARCHAR) AS DOUBLE), 0) AS BIGINT) AS fs,
         l_quantity AS q, l_extendedprice - 50000 AS p FROM lineitem),
g AS (
  SELECT fs, CASE WHEN fs = 1 THEN 1 ELSE 0 END AS alone,
         CASE WHEN fs > 0 AND fs <= 1 THEN 'Alone' WHEN fs > 1 AND fs <= 4 THEN 'Small'
              WHEN fs > 4 AND fs <= 6 THEN 'Medium' WHEN fs > 6 THEN 'Large' END AS size_group,
         CASE WHEN fs > 0 AND fs <= 1 THEN 'Alone' WHEN fs > 1 AND fs <= 4 THEN 'Small'
              WHEN fs > 4 THEN 'Large' END AS notebook_group,
         CASE WHEN q >= 0 AND q <= 12 THEN 'Child' WHEN q > 12 AND q <= 18 THEN 'Teen'
              WHEN q > 18 AND q <= 35 THEN 'Young Adult' WHEN q > 35 AND q <= 60 THEN 'Adult'
              WHEN q > 60 THEN 'Senior' END AS age_group,
         ln(1 + CASE WHEN p IS NULL THEN NULL ELSE GREATEST(p, 0) END) AS log_value FROM f)
SELECT size_group, notebook_group, age_group, COUNT(*) AS row_count,
       CAST(SUM(alone) AS BIGINT) AS alone_count, ROUND(AVG(log_value), 4) AS average_log_value,
       MAX(fs) AS max_size
FROM g GROUP BY size_group, notebook_group, age_group
""")
def q_numeric_features(spark, sf):
    li = table(spark, sf, "lineitem")
    fs = X.family_size(F.nullif(F.col("l_linenumber") - 1, F.lit(0)), F.floor(F.col("l_quantity") / 10).cast("string"))
    feats = li.select(fs.alias("fs"), F.col("l_quantity").alias("q"), (F.col("l_extendedprice") - 50000).alias("p"))
    feats = feats.select(
        "fs", X.equals_flag("fs", 1).alias("alone"),
        X.bin_column("fs", X.FAMILY_SIZE_EDGES, X.FAMILY_SIZE_LABELS).alias("size_group"),
        X.bin_column("fs", X.NOTEBOOK_FAMILY_EDGES, X.NOTEBOOK_FAMILY_LABELS).alias("notebook_group"),
        X.bin_column("q", X.AGE_GROUP_EDGES, X.AGE_GROUP_LABELS, include_lowest=True).alias("age_group"),
        X.clipped_log1p("p").alias("log_value"))
    return C.group_profile(feats, ["size_group", "notebook_group", "age_group"], {
        "alone_count": F.sum("alone").cast("long"),
        "average_log_value": X.rounded_avg("log_value", 4),
        "max_size": F.max("fs")})


@register("recode_labels", "P13 P14 P19", oracle="""
WITH r AS (
  SELECT CASE p_type WHEN 'ECONOMY' THEN 'eco' WHEN 'SMALL' THEN 'small' END AS type_code,
         (p_retailprice - 900) / 1200 AS prob, p_size % 4 AS cls FROM part)
SELECT COALESCE(type_code, 'other') AS type_code,
       CASE WHEN prob >= 0.8 THEN 'High model confidence' WHEN prob >= 0.6 THEN 'Moderate model confidence'
            ELSE 'Low model confidence' END AS confidence,
       CASE cls WHEN 1 THEN 'First class' WHEN 2 THEN 'Second class' WHEN 3 THEN 'Third class'
                ELSE 'Class ' || CAST(cls AS VARCHAR) END AS class_name,
       COUNT(*) AS row_count
FROM r GROUP BY ALL
""")
def q_recode_labels(spark, sf):
    p = table(spark, sf, "part").select(X.recode("p_type", {"ECONOMY": "eco", "SMALL": "small"}).alias("type_code"),
                                         ((F.col("p_retailprice") - 900) / 1200).alias("prob"),
                                         (F.col("p_size") % 4).alias("cls"))
    labelled = p.select(X.coalesce_default("type_code", "other").alias("type_code"),
                        X.confidence_band("prob").alias("confidence"), X.class_display_name("cls").alias("class_name"))
    return C.group_profile(labelled, ["type_code", "confidence", "class_name"], {})
