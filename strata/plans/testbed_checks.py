"""Queries whose results SQL can tell without fitting a model: class weights,
cross-validation of the majority class, correctness of scores, importances by
source column, and the written artifacts of the catalog and of the external job."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from strata.operators import evaluate as EV
from strata.operators import explain as XP
from strata.operators import models as M
from strata.operators import score as SC
from strata.operators import split as SP
from strata.plans.registry import register, table
from strata.plans.testbed_ml import _SOFTMAX_SQL, _softmax_probs
from strata.plans.testbed_overlap import _HARMONIZED_SQL, SPEC, _external_sql, external_source
from strata.plans.testbed_passenger import _PASSENGERS_SQL, _SQL, passengers
from strata.presets import passenger as P
from strata.session import checkpoint_dir
from strata.sources import catalog as CAT


def _folder(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


@register("class_weights", "M09", oracle="""
WITH c AS (SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY o_orderpriority)
SELECT o_orderpriority, n AS rows, ROUND((SELECT SUM(n) FROM c)::DOUBLE / ((SELECT COUNT(*) FROM c) * n), 9) AS weight,
       ROUND((SELECT SUM(n) FROM c)::DOUBLE / (SELECT COUNT(*) FROM c), 4) AS weight_of_class FROM c
""")
def q_class_weights(spark, sf):
    weighted = SP.with_class_weights(table(spark, sf, "orders"), "o_orderpriority")
    return weighted.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("weight"), 9).alias("weight"),
        F.round(F.sum("weight"), 4).alias("weight_of_class"))


# Blocks of a class differ by one row at most, larger ones first; so a fold's rows by class follow from the counts.
_MAJORITY_SQL = """
WITH c AS (SELECT lang AS label, COUNT(*) AS n FROM documents GROUP BY lang),
f AS (SELECT fold, label, n // 5 + (fold < n % 5)::INT AS held, n - n // 5 - (fold < n % 5)::INT AS fitted
      FROM c, (SELECT UNNEST(RANGE(5)) AS fold)),
s AS (SELECT fold, arg_max(held, fitted) / SUM(held) AS accuracy, arg_max(fitted, fitted) / SUM(fitted) AS fitted_accuracy,
             COUNT(*) AS k FROM f GROUP BY fold),
m AS (SELECT fold, accuracy, 1.0 / k AS balanced, 2 * accuracy / (1 + accuracy) / k AS f1,
             2 * fitted_accuracy / (1 + fitted_accuracy) / k AS fitted_f1 FROM s)
SELECT 'majority_class' AS model, ROUND(AVG(accuracy), 9) AS accuracy, ROUND(STDDEV_POP(accuracy), 9) AS accuracy_std,
       ROUND(AVG(balanced), 9) AS balanced_accuracy, ROUND(AVG(f1), 9) AS f1_macro, ROUND(STDDEV_POP(f1), 9) AS f1_macro_std,
       ROUND(AVG(fitted_f1), 9) AS fitted_f1_macro FROM m
"""


@register("cv_majority", "M06 M13 M14 M15", oracle=_MAJORITY_SQL)
def q_cv_majority(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars", "source")
    classes = M.sorted_classes(docs, "lang")
    data = SP.with_class_weights(docs.withColumn("label_idx", M.label_index("lang", classes)), "lang")
    folds = SP.stratified_folds(data, "lang", "doc_id", 5, 42)
    found = EV.cross_validate(lambda: M.configure("majority_class", {}, ["n_chars"], ["source"], 1.0, len(classes)),
                              folds, k=5, train_scores=True)
    names = {"accuracy": "cv_accuracy_mean", "accuracy_std": "cv_accuracy_std", "balanced_accuracy": "cv_balanced_accuracy_mean",
             "f1_macro": "cv_f1_macro_mean", "f1_macro_std": "cv_f1_macro_std", "fitted_f1_macro": "train_f1_macro_mean"}
    return spark.range(1).select(F.lit("majority_class").alias("model"),
                                 *[F.round(F.lit(found[v]), 9).alias(k) for k, v in names.items()])


@register("prediction_correctness", "G07 G05", oracle=_SOFTMAX_SQL + """
SELECT s.doc_id, d.n_chars % 3 + 1 AS label, s.pred AS PredictedClass, s.pred = d.n_chars % 3 + 1 AS PredictionCorrect
FROM s JOIN documents d USING (doc_id)""")
def q_prediction_correctness(spark, sf):
    labels = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") % 3 + 1).alias("label"))
    scored = SC.with_score_columns(_softmax_probs(spark, sf), F.col("probs"), [1, 2, 3]).join(labels, "doc_id")
    return SC.add_correctness(scored, "label").select("doc_id", "label", "PredictedClass", "PredictionCorrect")


@register("importance_by_source", "E08 A29 F26", oracle="""
WITH f AS (SELECT 'o_orderpriority_' || o_orderpriority AS feature, COUNT(*)::DOUBLE AS importance FROM orders GROUP BY 1
           UNION ALL SELECT 'o_orderstatus_' || o_orderstatus, COUNT(*) FROM orders GROUP BY 1
           UNION ALL SELECT 'o_order_' || o_orderstatus, COUNT(*) FROM orders GROUP BY 1
           UNION ALL SELECT 'o_totalprice', SUM(o_totalprice) / 1e6 FROM orders UNION ALL SELECT 'unknown_x', 7)
SELECT CASE WHEN feature LIKE 'o\\_orderpriority\\_%' ESCAPE '\\' THEN 'o_orderpriority'
            WHEN feature LIKE 'o\\_orderstatus\\_%' ESCAPE '\\' THEN 'o_orderstatus'
            WHEN feature LIKE 'o\\_order\\_%' ESCAPE '\\' THEN 'o_order' ELSE feature END AS source,
       ROUND(SUM(importance), 4) AS importance FROM f GROUP BY 1
""")
def q_importance_by_source(spark, sf):
    # the longest source that begins an encoded feature's name takes its importance
    orders = table(spark, sf, "orders")
    counts = [orders.groupBy(F.concat(F.lit(prefix), c).alias("feature")).agg(F.count(F.lit(1)).cast("double").alias("importance"))
              for prefix, c in (("o_orderpriority_", "o_orderpriority"), ("o_orderstatus_", "o_orderstatus"), ("o_order_", "o_orderstatus"))]
    parts = [*counts, orders.agg(F.lit("o_totalprice").alias("feature"), (F.sum("o_totalprice") / 1e6).alias("importance")),
             spark.range(1).select(F.lit("unknown_x").alias("feature"), F.lit(7.0).alias("importance"))]
    features = parts[0]
    for part in parts[1:]:
        features = features.unionByName(part)
    found = XP.aggregate_importance(features, ["o_order", "o_orderstatus", "o_orderpriority", "o_totalprice"])
    return found.select("source", F.round("importance", 4).alias("importance"))


_ASKED = ("14_ticket_prefix_profile", "02_passenger_class_distribution", "20_potential_duplicate_tickets")


def _subset_sql() -> str:
    names = sorted(n for n in _SQL if n in _ASKED)
    return " UNION ALL ".join(
        f"SELECT {i} AS place, '{name}' AS name, COUNT(*) AS rows, COUNT(*) AS exported, {len(names)} AS query_count"
        f" FROM ({_PASSENGERS_SQL + _SQL[name]})" for i, name in enumerate(names))


@register("catalog_subset", "S12 S13 S14", oracle=_subset_sql())
def q_catalog_subset(spark, sf):
    # asked for out of order, run in the catalog's; exports and manifest read back
    asked = [n for n in _ASKED if n in _SQL]
    P.register_views(spark, passengers(spark, sf))
    out = _folder(spark, "subset")
    results = CAT.run_analyses(spark, P.analysis_catalog(), out, requested=asked, required_tables=["passengers"])
    path = CAT.save_manifest(results, out, source="passengers")
    listed = spark.read.option("multiLine", True).json(path).select("query_count", F.posexplode("queries").alias("place", "q"))
    exports = None
    for r in results:
        one = spark.read.option("header", True).option("escape", '"').csv(r.output_path).agg(
            F.lit(r.name).alias("name"), F.count(F.lit(1)).alias("exported"))
        exports = one if exports is None else exports.unionByName(one)
    return listed.select("place", "q.name", "q.rows", "query_count").join(exports, "name")


@register("external_artifacts", "S20 H05 A27", oracle=f"""
WITH clean AS ({_HARMONIZED_SQL}), kept AS ({_external_sql()}),
n AS (SELECT (SELECT COUNT(*) FROM clean) AS clean_rows, (SELECT COUNT(*) FROM kept) AS kept_rows)
SELECT 'external_clean' AS name, clean_rows AS rows FROM n UNION ALL SELECT 'overlap_audit', clean_rows FROM n
UNION ALL SELECT 'external_nonoverlap', kept_rows FROM n UNION ALL SELECT 'summary external_rows', clean_rows FROM n
UNION ALL SELECT 'summary nonoverlap_rows', kept_rows FROM n
UNION ALL SELECT 'summary training_rows', (SELECT COUNT(*) FROM customer)
UNION ALL SELECT 'class_filter', 3 + 3 + (SELECT COUNT(DISTINCT lower(trim(c_mktsegment))) FROM customer
    WHERE lower(trim(c_mktsegment)) NOT IN ('automobile', 'building', 'furniture'))
""")
def q_external_artifacts(spark, sf):
    from strata.plans.external import prepare_external

    out = _folder(spark, "external")
    training = passengers(spark, sf).select("PassengerId", "Name", "Ticket")
    prepare_external(external_source(spark, sf).drop("c_custkey"), training, rule="either", spec=SPEC, output_dir=out)
    csv = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    tables = {"external_clean": spark.read.parquet(f"{out}/external_clean"), "overlap_audit": csv.csv(f"{out}/overlap_audit"),
              "external_nonoverlap": spark.read.parquet(f"{out}/external_nonoverlap"), "class_filter": csv.csv(f"{out}/class_filter")}
    parts = [t.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows")) for name, t in tables.items()]
    summary = spark.read.option("multiLine", True).json(f"{out}/external_overlap_summary.json")
    parts += [summary.select(F.lit(f"summary {c}").alias("name"), F.col(c).cast("long").alias("rows"))
              for c in ("external_rows", "nonoverlap_rows", "training_rows")]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found
