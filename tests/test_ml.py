import math

import pytest
from pyspark.sql import functions as F

from strata.operators import evaluate as EV
from strata.operators import score as SC
from strata.operators import split as SP
from strata.operators.models import MajorityClassifier


def labelled(spark, n=300):
    return spark.createDataFrame([(i, [1, 2, 3][i % 7 % 3]) for i in range(n)], "id long, label long")


def test_hash_rank_matches_brute_force(spark):
    df = spark.createDataFrame([(i, i % 3, (i * 37) % 101 - 50) for i in range(300)], "id long, g long, k long")
    key = F.xxhash64("k")
    got = {r.id: r.rank for r in SP.hash_rank(df.repartition(5), "g", key, ["id"], bits=3).collect()}
    rows = sorted((r.g, r.key % (1 << 64), r.id) for r in df.withColumn("key", key).collect())
    expect, last, r = {}, None, 0
    for g, _, i in rows:
        r = r + 1 if g == last else 0
        last = g
        expect[i] = r
    assert got == expect


def test_split_is_exact_and_complete_on_three_million_rows(spark):
    n = 3_000_000
    df = spark.range(0, n, numPartitions=9).select(
        "id", (F.col("id") % 7 % 3).alias("label"), F.sha1(F.col("id").cast("string")).alias("payload"))
    counts = SP.class_counts(df, "label")
    quotas = SP.holdout_quotas(counts, 0.2)
    agg = (SP.stratified_split(df, "label", "id").groupBy("label", "is_test")
           .agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids")))
    got = {(r.label, r.is_test): (r.n, r.ids) for r in agg.collect()}
    for c, k in counts.items():
        assert got[(c, True)] == (quotas[c], quotas[c])
        assert got[(c, False)] == (k - quotas[c], k - quotas[c])
    folds = SP.stratified_folds(df, "label", "id", 5).groupBy("label", "fold").count().collect()
    assert sum(r["count"] for r in folds) == n and {r.fold for r in folds} == set(range(5))
    for c, k in counts.items():
        sizes = [r["count"] for r in folds if r.label == c]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == k


def test_split_quotas_and_folds(spark):
    df = labelled(spark)
    counts = SP.class_counts(df, "label")
    quotas = SP.holdout_quotas(counts, 0.2)
    assert sum(quotas.values()) == math.ceil(0.2 * 300)
    s = SP.stratified_split(df, "label", "id")
    got = {r.label: r.n for r in s.filter("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert got == quotas
    assert s.collect() and SP.stratified_split(df, "label", "id").filter("is_test").count() == 60
    f = SP.stratified_folds(df, "label", "id", 5)
    sizes = f.groupBy("label", "fold").count().collect()
    for lab, n in counts.items():
        fold_sizes = sorted(r["count"] for r in sizes if r.label == lab)
        assert max(fold_sizes) - min(fold_sizes) <= 1 and sum(fold_sizes) == n


def test_metrics_from_confusion(spark):
    pairs = [(1, 1), (1, 1), (1, 2), (2, 2), (2, 1), (3, 3), (3, 1)]
    df = spark.createDataFrame(pairs, "y long, p long")
    m = EV.metrics_from_confusion(EV.confusion_counts(df, "y", "p")).first()
    assert m.accuracy == pytest.approx(4 / 7)
    recalls = [2 / 3, 1 / 2, 1 / 2]
    assert m.balanced_accuracy == pytest.approx(sum(recalls) / 3)
    precisions = [2 / 4, 1 / 2, 1.0]
    f1 = [2 * p * r / (p + r) for p, r in zip(precisions, recalls)]
    assert m.f1_macro == pytest.approx(sum(f1) / 3)
    rep = {r.label: r for r in EV.classification_report(EV.confusion_counts(df, "y", "p")).collect()}
    assert rep["accuracy"]["f1-score"] == pytest.approx(round(4 / 7, 4))
    assert rep["1"].support == 3


def test_majority_and_scores(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.0,)], "label_idx double")
    model = MajorityClassifier(labelCol="label_idx", numClasses=2).fit(df)
    assert {r.prediction for r in model.transform(df).collect()} == {1.0}
    probs = spark.createDataFrame([(1, [0.2, 0.5, 0.3]), (2, [0.9, 0.05, 0.05])], "id long, p array<double>")
    SC.check_probabilities(probs, F.col("p"), 3)
    out = {r.id: r for r in SC.with_score_columns(probs, F.col("p"), [1, 2, 3]).collect()}
    assert out[1].PredictedClass == 2 and out[1].PredictionConfidence == 0.5
    assert out[1].SecondHighestProbability == 0.3 and out[1].LowConfidence
    assert out[2].ProbabilityMargin == pytest.approx(0.85) and not out[2].LowConfidence
    bad = spark.createDataFrame([(1, [0.2, 0.2, 0.2])], "id long, p array<double>")
    with pytest.raises(ValueError):
        SC.check_probabilities(bad, F.col("p"), 3)


def test_quantiles_of_many_and_tied_values(spark):
    import numpy as np

    from strata.operators import quantiles as QN
    n = 200_000
    df = spark.range(0, n, numPartitions=7).select(
        (F.col("id") % 3).alias("g"), F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.rand(seed=3)).alias("v"))
    df = spark.createDataFrame(df.toPandas())
    pdf = df.toPandas()
    for r in QN.quantiles_long(df, ["v"], [0.0, 0.1, 0.5, 0.999, 1.0], ["g"]).collect():
        assert abs(r.value - np.percentile(pdf.v[pdf.g == r.g], r.p * 100)) < 1e-12


def test_normalize_report_layouts(spark):
    other = spark.createDataFrame([("1", 0.5, 0.4, 0.44, 10)], "class string, precision double, recall double, "
                                                                "f1_score double, count long")
    out = EV.normalize_classification_report(other)
    assert out.columns == list(EV.REPORT_COLUMNS)
    assert out.first()["f1-score"] == 0.44 and out.first().support == 10


def test_split_is_reproducible(spark):
    df = labelled(spark)
    a = {r.id: r.is_test for r in SP.stratified_split(df, "label", "id", seed=42).collect()}
    b = {r.id: r.is_test for r in SP.stratified_split(df.repartition(3), "label", "id", seed=42).collect()}
    c = {r.id: r.is_test for r in SP.stratified_split(df, "label", "id", seed=7).collect()}
    assert a == b and a != c


def test_tuned_variant_needs_strict_improvement(spark):
    from strata.operators.tune import TuningResult, keep_tuned, sample_parameters
    res = TuningResult("m", {}, 0.80, None)
    assert not keep_tuned(0.80, res) and keep_tuned(0.79, res)
    space = {"a": [1, 2, 3], "b": ["x", "y"]}
    assert sample_parameters(space, 4, seed=1) == sample_parameters(space, 4, seed=1)
    assert len({str(p) for p in sample_parameters(space, 10, seed=1)}) == 6


def test_approximate_split_and_folds(spark):
    df = spark.range(0, 20000).selectExpr("id", "id % 3 AS label")
    s = SP.stratified_split(df, "label", "id", 0.2, exact=False)
    share = s.filter("is_test").count() / 20000
    assert abs(share - 0.2) < 0.02
    f = SP.stratified_folds(df, "label", "id", 5, exact=False)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) < 400
    assert "Exchange" not in f._jdf.queryExecution().executedPlan().toString()


def test_format_comparison(spark):
    cols = list(EV.COMPARISON_COLUMNS)
    rows = [("a", 0.5, 0.01, 0.5, 0.01, 0.6, 0.02, 1.23456, 0.1), ("b", 0.7, 0.01, 0.6, 0.01, 0.7, 0.02, 2.0, 0.2)]
    df = spark.createDataFrame(rows, cols)
    out = EV.format_comparison(df, 2).collect()
    assert [r.model for r in out] == ["b", "a"] and out[1].fit_time_mean == 1.23
    assert EV.select_best(EV.format_comparison(df)) == "b"


@pytest.mark.parametrize("classes", [3, 40])
def test_split_and_folds_do_not_depend_on_where_the_counts_are(spark, monkeypatch, classes):
    from strata.operators import quantiles as QN

    rows = [(i, f"c{(i * i) % classes:03d}" if i % 11 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, label string").repartition(4)

    def both():
        split = SP.stratified_split(df, "label", "id", 0.23, 5)
        folds = SP.stratified_folds(df, "label", "id", 4, 5)
        return ({r.id: r.is_test for r in split.collect()}, {r.id: r.fold for r in folds.collect()})

    local = both()
    monkeypatch.setattr(QN, "BROADCAST_GROUPS", 2)
    assert both() == local
    assert sum(local[0].values()) == -(-23 * 3000 // 100)
    few = df.filter("id < 5")
    for held in (100_000, 0):
        monkeypatch.setattr(QN, "BROADCAST_GROUPS", held)
        with pytest.raises(ValueError, match="at least 4 rows"):
            SP.stratified_folds(few, "label", "id", 4)


def test_forest_keeps_node_ids_and_grows_the_same_trees(spark):
    from pyspark.ml.functions import array_to_vector
    from strata.operators.models import random_forest
    x = [(F.xxhash64(F.lit(i), "id") % 1000).cast("double") for i in range(6)]
    rows = spark.range(0, 600, 1, 3).select(array_to_vector(F.array(*x)).alias("features"), F.lit(1.0).alias("weight"),
                                            (F.abs(F.xxhash64(F.lit(9), "id")) % 3).cast("double").alias("label_idx")).cache()
    forest = random_forest(num_trees=4)
    assert forest.getCacheNodeIds()
    kept, walked = forest.fit(rows), forest.copy().setCacheNodeIds(False).fit(rows)
    assert kept.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]
    assert max(t.depth for t in kept.trees) > forest.getCheckpointInterval()
    rows.unpersist()
