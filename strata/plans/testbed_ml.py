"""ML preparation, evaluation and scoring queries on the driver tables.

Split/fold queries report per-class counts (the hash order itself is
Spark-specific). Evaluation uses ``labels`` joined to ``documents`` with a
rule prediction; scoring uses fixed softmax scores derived from documents.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from strata.functions.exprs import CLASS_DISPLAY_NAMES
from strata.operators import evaluate as EV
from strata.operators import score as SC
from strata.operators import split as SP
from strata.operators.mlprep import MedianImputer, PopulationScaler
from strata.operators.models import MajorityClassifier
from strata.operators.mlprep import preprocessing_stages
from strata.plans.registry import register, table


@register("split_counts", "M12", oracle="""
WITH c AS (SELECT label, COUNT(*) AS n FROM embeddings GROUP BY label),
t AS (SELECT CAST(CEIL(0.2::DOUBLE * SUM(n)) AS BIGINT) AS nt, SUM(n) AS total FROM c),
q AS (SELECT c.label, c.n, t.nt * c.n / t.total AS ex, FLOOR(t.nt * c.n / t.total) AS base FROM c, t),
r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY ex - base DESC, label) AS rk FROM q),
lo AS (SELECT (SELECT nt FROM t) - SUM(base) AS l FROM q)
SELECT label, n AS rows, (base + CASE WHEN rk <= (SELECT l FROM lo) THEN 1 ELSE 0 END)::BIGINT AS test_rows,
       (n - base - CASE WHEN rk <= (SELECT l FROM lo) THEN 1 ELSE 0 END)::BIGINT AS train_rows
FROM r
""")
def q_split_counts(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    s = SP.stratified_split(e, "label", "vec_id", 0.2, 42)
    return s.groupBy("label").agg(F.count(F.lit(1)).alias("rows"),
                                  F.sum(F.col("is_test").cast("int")).cast("long").alias("test_rows"),
                                  F.sum((~F.col("is_test")).cast("int")).cast("long").alias("train_rows"))


@register("fold_counts", "M13", oracle="""
WITH c AS (SELECT label, COUNT(*) AS n FROM embeddings GROUP BY label)
SELECT label, f.fold::INT AS fold, (n // 5 + CASE WHEN f.fold < n % 5 THEN 1 ELSE 0 END)::BIGINT AS rows
FROM c, (SELECT range AS fold FROM range(5)) f
""")
def q_fold_counts(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    folds = SP.stratified_folds(e, "label", "vec_id", 5, 42)
    return folds.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("rows"))


@register("impute_scale", "M01 M02 M05", oracle="""
WITH t AS (SELECT p_partkey, NULLIF(p_size, 11)::DOUBLE AS s, NULLIF(p_retailprice, 901.0) AS p FROM part),
m AS (SELECT MEDIAN(s) AS ms, MEDIAN(p) AS mp FROM t),
i AS (SELECT p_partkey, COALESCE(s, ms) AS s, COALESCE(p, mp) AS p FROM t, m),
z AS (SELECT AVG(s) AS a_s, STDDEV_POP(s) AS d_s, AVG(p) AS a_p, STDDEV_POP(p) AS d_p FROM i)
SELECT p_partkey, ROUND((s - a_s) / d_s, 6) AS size_scaled, ROUND((p - a_p) / d_p, 6) AS price_scaled FROM i, z
""")
def q_impute_scale(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", F.nullif("p_size", F.lit(11)).cast("double").alias("s"),
                                         F.nullif("p_retailprice", F.lit(901.0)).alias("p"))
    model = Pipeline(stages=[MedianImputer(inputCols=["s", "p"]), PopulationScaler(inputCols=["s", "p"])]).fit(t)
    out = model.transform(t)
    return out.select("p_partkey", F.round("s", 6).alias("size_scaled"), F.round("p", 6).alias("price_scaled"))


@register("onehot", "M03 M04 M05", oracle="""
WITH t AS (SELECT p_partkey, NULLIF(p_type, 'SMALL') AS ty, p_type FROM part),
tr AS (SELECT * FROM t WHERE p_type <> 'ECONOMY'),
m AS (SELECT ty AS mode_ty FROM tr WHERE ty IS NOT NULL GROUP BY ty ORDER BY COUNT(*) DESC, ty LIMIT 1),
cats AS (SELECT list_sort(list(DISTINCT COALESCE(ty, mode_ty))) AS cs FROM tr, m),
f AS (SELECT p_partkey, COALESCE(ty, mode_ty) AS filled FROM t, m)
SELECT p_partkey, filled,
       array_to_string(list_transform(cs, lambda c: CASE WHEN c = filled THEN '1.0' ELSE '0.0' END), ',') AS onehot
FROM f, cats
""")
def q_onehot(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", F.nullif("p_type", F.lit("SMALL")).alias("ty"), "p_type")
    train = t.filter(F.col("p_type") != "ECONOMY")
    stages = preprocessing_stages([], ["ty"], features_col="vec")
    model = Pipeline(stages=stages).fit(train)
    out = model.transform(t)
    return out.select("p_partkey", F.col("ty").alias("filled"),
                      F.array_join(vector_to_array("vec").cast("array<string>"), ",").alias("onehot"))


@register("majority_baseline", "M06", oracle="""
WITH m AS (SELECT quality FROM labels WHERE doc_id % 2 = 0 GROUP BY quality ORDER BY COUNT(*) DESC, quality LIMIT 1)
SELECT (SELECT quality FROM m)::DOUBLE AS prediction, COUNT(*) AS rows FROM labels WHERE doc_id % 2 = 1
""")
def q_majority_baseline(spark, sf):
    lab = table(spark, sf, "labels").withColumn("label_idx", F.col("quality").cast("double"))
    model = MajorityClassifier(labelCol="label_idx", numClasses=2).fit(lab.filter(F.col("doc_id") % 2 == 0))
    pred = model.transform(lab.filter(F.col("doc_id") % 2 == 1))
    return pred.groupBy("prediction").agg(F.count(F.lit(1)).alias("rows"))


def _rule_predictions(spark, sf, cut=2000):
    lab = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    j = lab.join(docs, "doc_id")
    return j.select("doc_id", F.col("quality").alias("truth"),
                    F.when(F.col("n_chars") > cut, 1).otherwise(0).alias("pred"))


_CONF_SQL = """
WITH p AS (SELECT l.quality AS truth, CASE WHEN d.n_chars > {cut} THEN 1 ELSE 0 END AS pred
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
labs AS (SELECT DISTINCT v FROM (SELECT truth AS v FROM p UNION ALL SELECT pred FROM p)),
grid AS (SELECT a.v AS label, b.v AS predicted FROM labs a, labs b),
cnt AS (SELECT truth AS label, pred AS predicted, COUNT(*) AS n FROM p GROUP BY ALL),
conf AS (SELECT g.label, g.predicted, COALESCE(c.n, 0)::BIGINT AS count FROM grid g
         LEFT JOIN cnt c ON g.label = c.label AND g.predicted = c.predicted),
pc AS (SELECT c.label, MAX(CASE WHEN c.label = c.predicted THEN c.count END) AS tp, SUM(c.count) AS support,
              (SELECT SUM(count) FROM conf x WHERE x.predicted = c.label) AS predicted_total
       FROM conf c GROUP BY c.label),
pr AS (SELECT *, CASE WHEN predicted_total > 0 THEN tp / predicted_total ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pc),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END
                AS f1 FROM pr)"""


@register("confusion", "E01", oracle=_CONF_SQL.format(cut=2000) + " SELECT label, predicted, count FROM conf")
def q_confusion(spark, sf):
    return EV.confusion_counts(_rule_predictions(spark, sf), "truth", "pred")


@register("confusion_norm", "E01", oracle=_CONF_SQL.format(cut=2000) + """
SELECT label, predicted, count,
       ROUND(CASE WHEN SUM(count) OVER (PARTITION BY label) > 0
                  THEN count / SUM(count) OVER (PARTITION BY label) ELSE 0.0 END, 4) AS value
FROM conf""")
def q_confusion_norm(spark, sf):
    return EV.normalize_confusion(EV.confusion_counts(_rule_predictions(spark, sf), "truth", "pred"), "true")


@register("eval_metrics", "E02 E05", oracle=_CONF_SQL.format(cut=2000) + """
SELECT ROUND(SUM(tp) / SUM(support), 6) AS accuracy,
       ROUND(AVG(CASE WHEN support > 0 THEN recall END), 6) AS balanced_accuracy,
       ROUND(AVG(f1), 6) AS f1_macro, SUM(support)::BIGINT AS rows FROM f""")
def q_eval_metrics(spark, sf):
    preds = _rule_predictions(spark, sf)
    EV.validate_labels(preds, "truth", [0, 1])
    return EV.metrics_from_confusion(EV.confusion_counts(preds, "truth", "pred"), decimals=6)


@register("class_report", "E03 E04", oracle=_CONF_SQL.format(cut=2000) + """
SELECT CAST(label AS VARCHAR) AS label, ROUND(precision, 4) AS precision, ROUND(recall, 4) AS recall,
       ROUND(f1, 4) AS "f1-score", support::BIGINT AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(SUM(tp) / SUM(support), 4), SUM(support)::BIGINT FROM f
UNION ALL SELECT 'macro avg', ROUND(AVG(precision), 4), ROUND(AVG(recall), 4), ROUND(AVG(f1), 4),
                 SUM(support)::BIGINT FROM f
UNION ALL SELECT 'weighted avg', ROUND(SUM(precision * support) / SUM(support), 4),
                 ROUND(SUM(recall * support) / SUM(support), 4), ROUND(SUM(f1 * support) / SUM(support), 4),
                 SUM(support)::BIGINT FROM f""")
def q_class_report(spark, sf):
    return EV.classification_report(EV.confusion_counts(_rule_predictions(spark, sf), "truth", "pred"))


@register("metric_compare", "J08 E06", oracle="""
WITH m1 AS ({a}), m2 AS ({b}),
l1 AS (UNPIVOT m1 ON accuracy, balanced_accuracy, f1_macro INTO NAME metric VALUE value),
l2 AS (UNPIVOT m2 ON accuracy, balanced_accuracy, f1_macro INTO NAME metric VALUE value)
SELECT l1.metric, l1.value AS internal, l2.value AS external, ROUND(l2.value - l1.value, 4) AS change
FROM l1 JOIN l2 USING (metric)
""".format(
    a=_CONF_SQL.format(cut=2000) + " SELECT ROUND(SUM(tp) / SUM(support), 6) AS accuracy, "
      "ROUND(AVG(CASE WHEN support > 0 THEN recall END), 6) AS balanced_accuracy, ROUND(AVG(f1), 6) AS f1_macro FROM f",
    b=_CONF_SQL.format(cut=1000) + " SELECT ROUND(SUM(tp) / SUM(support), 6) AS accuracy, "
      "ROUND(AVG(CASE WHEN support > 0 THEN recall END), 6) AS balanced_accuracy, ROUND(AVG(f1), 6) AS f1_macro FROM f"))
def q_metric_compare(spark, sf):
    def metrics(cut):
        m = EV.metrics_from_confusion(EV.confusion_counts(_rule_predictions(spark, sf, cut), "truth", "pred"),
                                      decimals=6).drop("rows")
        return EV.metrics_table(m)
    return EV.compare_metrics(metrics(2000), metrics(1000))


# --------------------------------------------------------------------------
# Scoring columns from fixed softmax scores over documents
# --------------------------------------------------------------------------

def _softmax_probs(spark, sf):
    d = table(spark, sf, "documents")
    logits = [F.col("n_chars") / 5000.0, (F.col("doc_id") % 7) / 3.0, F.length("lang") * 0.5]
    ex = [F.exp(lg) for lg in logits]
    total = ex[0] + ex[1] + ex[2]
    return d.select("doc_id", F.array(*[e / total for e in ex]).alias("probs"))


_SOFTMAX_SQL = """
WITH e AS (SELECT doc_id, exp(n_chars / 5000.0) AS e1, exp((doc_id % 7) / 3.0) AS e2, exp(length(lang) * 0.5) AS e3
           FROM documents),
p AS (SELECT doc_id, e1 / (e1 + e2 + e3) AS p1, e2 / (e1 + e2 + e3) AS p2, e3 / (e1 + e2 + e3) AS p3 FROM e),
s AS (SELECT *, GREATEST(p1, p2, p3) AS conf,
             CASE WHEN p1 >= p2 AND p1 >= p3 THEN 1 WHEN p2 >= p3 THEN 2 ELSE 3 END AS pred,
             list_sort([p1, p2, p3])[2] AS second FROM p)"""


@register("score_columns", "G03 N05 P19", oracle=_SOFTMAX_SQL + """
SELECT doc_id, pred AS PredictedClass, ROUND(p1, 6) AS ProbabilityClass1, ROUND(p2, 6) AS ProbabilityClass2,
       ROUND(p3, 6) AS ProbabilityClass3, ROUND(conf, 6) AS PredictionConfidence,
       ROUND(second, 6) AS SecondHighestProbability, ROUND(ROUND(conf, 6) - ROUND(second, 6), 6) AS ProbabilityMargin,
       conf < 0.6 AS LowConfidence,
       CASE WHEN ROUND(conf, 6) >= 0.8 THEN 'High model confidence' WHEN ROUND(conf, 6) >= 0.6
            THEN 'Moderate model confidence' ELSE 'Low model confidence' END AS ConfidenceBand
FROM s""")
def q_score_columns(spark, sf):
    p = _softmax_probs(spark, sf)
    SC.check_probabilities(p, F.col("probs"), 3)
    scored = SC.with_score_columns(p, F.col("probs"), [1, 2, 3], decimals=6).drop("probs")
    return SC.with_confidence_band(scored)


@register("score_summary", "A26 G08", oracle=_SOFTMAX_SQL + """
SELECT COUNT(*) AS rows, ROUND(AVG(conf), 4) AS mean_confidence, ROUND(MEDIAN(conf), 4) AS median_confidence,
       ROUND(MIN(conf), 4) AS min_confidence, ROUND(MAX(conf), 4) AS max_confidence,
       SUM(CASE WHEN conf < 0.6 THEN 1 ELSE 0 END)::BIGINT AS low_confidence_count,
       ROUND(100.0 * AVG(CASE WHEN conf < 0.6 THEN 1.0 ELSE 0.0 END), 2) AS low_confidence_percent
FROM s""")
def q_score_summary(spark, sf):
    scored = SC.with_score_columns(_softmax_probs(spark, sf), F.col("probs"), [1, 2, 3])
    # confidence re-derived from the probability columns (G08 fallback)
    scored = scored.withColumn(SC.CONFIDENCE, SC.confidence_from_columns(scored))
    return SC.prediction_summary(scored, [1, 2, 3])


@register("score_class_distribution", "A26", oracle=_SOFTMAX_SQL + """
SELECT pred AS predicted_class, COUNT(*) AS rows,
       ROUND(100.0 * CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), 2) AS percent FROM s GROUP BY pred""")
def q_score_class_distribution(spark, sf):
    scored = SC.with_score_columns(_softmax_probs(spark, sf), F.col("probs"), [1, 2, 3])
    return SC.class_distribution(scored)


@register("probabilities_long", "G09", oracle=_SOFTMAX_SQL + """
SELECT doc_id, CAST(cls AS VARCHAR) AS class,
       CASE cls WHEN 1 THEN 'First class' WHEN 2 THEN 'Second class' ELSE 'Third class' END AS class_name,
       ROUND(p, 6) AS probability
FROM (SELECT doc_id, 1 AS cls, p1 AS p FROM s UNION ALL SELECT doc_id, 2, p2 FROM s UNION ALL SELECT doc_id, 3, p3 FROM s)
""")
def q_probabilities_long(spark, sf):
    scored = SC.with_score_columns(_softmax_probs(spark, sf), F.col("probs"), [1, 2, 3], decimals=6)
    return SC.probabilities_long(scored, "doc_id", [1, 2, 3], CLASS_DISPLAY_NAMES)


@register("rank_results", "N03 M18", oracle="""
SELECT p_brand AS brand, ROUND(AVG(p_retailprice), 2) AS mean_score,
       RANK() OVER (ORDER BY ROUND(AVG(p_retailprice), 2) DESC) AS rank_score
FROM part GROUP BY p_brand
""")
def q_rank_results(spark, sf):
    from strata.operators.tune import rank_results
    part = table(spark, sf, "part")
    res = part.groupBy(F.col("p_brand").alias("brand")).agg(F.round(F.avg("p_retailprice"), 2).alias("mean_score"))
    return rank_results(res, "mean_score", "rank_score")


@register("context_join", "J02 J07 G05 P02", oracle=_SOFTMAX_SQL + """
SELECT s.doc_id, d.lang, d.source, s.pred AS PredictedClass, ROUND(s.conf, 6) AS PredictionConfidence
FROM s JOIN documents d ON s.doc_id = d.doc_id""")
def q_context_join(spark, sf):
    from strata.plans.scoring import add_context_columns
    scored = SC.with_score_columns(_softmax_probs(spark, sf), F.col("probs"), [1, 2, 3], decimals=6)
    scored = scored.select("doc_id", SC.PREDICTION, SC.CONFIDENCE)
    docs = table(spark, sf, "documents")
    return add_context_columns(scored, docs, "doc_id", ["lang", "source"], preferred=["lang"])


@register("lowest_confidence", "O06 P19", oracle=_SOFTMAX_SQL + """
SELECT doc_id, pred AS PredictedClass, ROUND(conf, 6) AS PredictionConfidence,
       CASE WHEN ROUND(conf, 6) >= 0.8 THEN 'High model confidence' WHEN ROUND(conf, 6) >= 0.6
            THEN 'Moderate model confidence' ELSE 'Low model confidence' END AS ConfidenceBand
FROM s ORDER BY ROUND(conf, 6), doc_id LIMIT 10""")
def q_lowest_confidence(spark, sf):
    from strata.operators.cohort import top_k
    scored = SC.with_score_columns(_softmax_probs(spark, sf), F.col("probs"), [1, 2, 3], decimals=6)
    scored = SC.with_confidence_band(scored).select("doc_id", SC.PREDICTION, SC.CONFIDENCE, "ConfidenceBand")
    return top_k(scored, [F.col(SC.CONFIDENCE).asc(), F.col("doc_id")], 10)
