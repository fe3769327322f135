import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from strata.operators import forest as FO
from strata.operators.models import random_forest


def rows_of(spark, n=400, values=40, classes=3, parts=3):
    x = [F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(values)).cast("double") for i in range(5)]
    noise = F.abs(F.xxhash64(F.lit(9), "id")) % 3
    label = F.pmod(F.floor(x[0] / 10) + F.floor(x[1] / 15) + F.when(noise == 0, 1).otherwise(0), F.lit(classes))
    return spark.range(0, n, 1, parts).select("id", array_to_vector(F.array(*x)).alias("features"),
                                              label.cast("double").alias("label_idx"),
                                              (1.0 + F.col("id") % 3).alias("weight"))


def scored(model, rows):
    out = model.transform(rows).select("id", "prediction", vector_to_array("probability").alias("p"))
    return {r.id: (r.prediction, [round(p, 9) for p in r.p]) for r in out.collect()}


@pytest.mark.parametrize("depth,least", [(2, 1), (6, 2), (30, 4)])
def test_a_tree_without_draws_is_spark_mls_tree(spark, depth, least):
    # all features and all rows: nothing is drawn, so the rules alone decide
    rows = rows_of(spark).cache()
    own = random_forest(num_trees=1, min_leaf=least, max_depth=depth, feature_subset="all", bootstrap=False, maxMemoryInMB=64)
    plain = RandomForestClassifier(**{p.name: v for p, v in own.extractParamMap().items() if p.name != "leafCol"})
    a, b = own.fit(rows), plain.fit(rows)
    assert isinstance(a, FO.ForestModel) and isinstance(b, RandomForestClassificationModel)
    assert [(t.depth, t.nodes) for t in a.trees] == [(t.depth, t.numNodes) for t in b.trees]
    assert scored(a, rows) == scored(b, rows)
    assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray(), atol=1e-9)
    rows.unpersist()


def test_forest_does_not_depend_on_partitions_or_order(spark):
    rows = rows_of(spark)
    forest = random_forest(num_trees=7)
    first = scored(forest.fit(rows), rows)
    assert first == scored(forest.fit(rows.orderBy(F.desc("id")).repartition(5)), rows)
    other = random_forest(num_trees=7, seed=5)
    assert first != scored(other.fit(rows), rows)


def test_forest_learns_as_well_as_spark_mls(spark):
    rows = rows_of(spark, 900).cache()
    train, test = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    right = lambda m: m.transform(test).agg(F.avg((F.col("prediction") == F.col("label_idx")).cast("double"))).first()[0]
    own = random_forest(num_trees=20)
    plain = RandomForestClassifier(featuresCol="features", labelCol="label_idx", weightCol="weight", numTrees=20,
                                   minInstancesPerNode=2, maxDepth=30, featureSubsetStrategy="sqrt", seed=42, maxBins=64)
    assert right(own.fit(train)) > right(plain.fit(train)) - 0.06
    rows.unpersist()


def test_bootstrap_counts_are_poisson_and_copies_count_each():
    digest = np.random.default_rng(1).integers(-2**62, 2**62, 200_000)
    for times in (1, 7):
        c = FO.bootstrap_counts(digest, np.full(len(digest), times), 3, 42)
        assert abs(c.mean() - times) < 0.03 * times and abs(c.var() - times) < 0.03 * times
        # a draw is the row's own, whatever stands around it
        assert (FO.bootstrap_counts(digest[::-1], np.full(len(digest), times), 3, 42)[::-1] == c).all()
    a, b = (FO.bootstrap_counts(digest, np.ones(len(digest), int), t, 42) for t in (0, 1))
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01


def test_copies_of_a_row_weigh_as_many_rows(spark):
    rows = rows_of(spark, 200)
    many = rows.unionByName(rows.filter("id % 2 = 0")).unionByName(rows.filter("id % 2 = 0"))
    own = random_forest(num_trees=1, min_leaf=3, feature_subset="all", bootstrap=False)
    plain = RandomForestClassifier(**{p.name: v for p, v in own.extractParamMap().items() if p.name != "leafCol"})
    assert scored(own.fit(many), rows) == scored(plain.fit(many), rows)


def test_forest_in_a_saved_pipeline_scores_as_before(spark, tmp_path):
    rows = rows_of(spark, 150)
    model = Pipeline(stages=[random_forest(num_trees=3)]).fit(rows)
    model.write().overwrite().save(str(tmp_path / "model"))
    assert scored(PipelineModel.load(str(tmp_path / "model")), rows) == scored(model, rows)


def test_what_the_forest_has_no_rule_for_goes_through_spark_ml(spark, monkeypatch):
    rows = rows_of(spark, 120)
    assert isinstance(random_forest(num_trees=2, impurity="entropy").fit(rows), RandomForestClassificationModel)
    monkeypatch.setattr(FO, "MOST_BYTES", 100)
    assert isinstance(random_forest(num_trees=2).fit(rows), RandomForestClassificationModel)


def test_rows_without_valid_values_and_empty_tables_are_refused(spark):
    rows = rows_of(spark, 60)
    forest = random_forest(num_trees=2)
    for bad in (rows.withColumn("label_idx", F.when(F.col("id") > 3, F.col("label_idx"))),
                rows.withColumn("weight", F.lit(-1.0)),
                rows.withColumn("features", array_to_vector(F.array(F.lit(float("nan"))))), rows.filter("id < 0")):
        with pytest.raises(ValueError):
            forest.fit(bad)
    assert len(scored(forest.fit(rows), rows.filter("id < 0"))) == 0
