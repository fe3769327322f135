from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from strata.operators import evaluate as EV
from strata.operators import explain as XP
from strata.operators import models as M
from strata.operators.mlprep import FillValuesModel, MedianImputer, preprocessing_stages

FEATURES = ["x", "z", "kind"]


def _rows(spark):
    rows = [(i, float(i % 3), float(i % 3) + (i * 7919 % 13) / 13.0, None if i % 11 == 0 else float(i * 31 % 17), "abc"[i * 5 % 3] if i % 7 else None)
            for i in range(120)]
    return spark.createDataFrame(rows, "row_id long, label_idx double, x double, z double, kind string").withColumn("weight", F.lit(1.0))


def _classifier():
    return LogisticRegression(featuresCol="features", labelCol="label_idx", regParam=0.01)


class _Counting(FillValuesModel):
    """Fills values, counting the rows that come by."""

    def _transform(self, df):
        seen = self.seen

        def tell(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return super()._transform(df).mapInArrow(tell, df.schema)


def _counting(spark, fitted):
    first = _Counting(inputCols=fitted.stages[0].getInputCols(), values=fitted.stages[0].getOrDefault("values"))
    first.seen = spark.sparkContext.accumulator(0)
    return first, PipelineModel([first, *fitted.stages[1:]])


def test_permutation_prepares_each_row_once(spark):
    df = _rows(spark)
    fitted = Pipeline(stages=[*preprocessing_stages(["x", "z"], ["kind"]), _classifier()]).fit(df)
    first, model = _counting(spark, fitted)
    XP.permutation_importance(model, df, FEATURES, repeats=3).collect()
    assert first.seen.value == 120


def test_slots_and_whole_pipeline_give_the_same_importances(spark, monkeypatch):
    df = _rows(spark)
    model = Pipeline(stages=[*preprocessing_stages(["x", "z"], ["kind"]), _classifier()]).fit(df)
    prepared = PipelineModel(model.stages[:-1]).transform(df)
    assert XP.feature_slots(model, prepared, [*FEATURES, "unused"]) == {"x": (0, 1), "z": (1, 2), "kind": (2, 5), "unused": (0, 0)}
    by_slots = XP.permutation_importance(model, df, FEATURES, repeats=3).collect()
    monkeypatch.setattr(XP, "feature_slots", lambda *a: None)
    whole = XP.permutation_importance(model, df, FEATURES, repeats=3).collect()
    measures = lambda rows: {r.feature: (round(r.importance_mean, 9), round(r.importance_std, 9)) for r in rows}
    assert measures(by_slots) == measures(whole) and by_slots[0].importance_mean > 0.1


def test_confusion_counts_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def tell(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(i % 2, i % 3) for i in range(60)], "y int, p int")
    cells = EV.confusion_counts(df.mapInArrow(tell, df.schema), "y", "p").collect()
    assert len(cells) == 9 and sum(r["count"] for r in cells) == 60
    assert seen.value == 60


def test_candidates_and_draws_share_the_preparation_of_a_fold(spark, monkeypatch):
    from strata.operators import tune as T
    fits = []
    plain = MedianImputer._fit
    monkeypatch.setattr(MedianImputer, "_fit", lambda self, df: fits.append(1) or plain(self, df))
    folds = _rows(spark).withColumn("fold", (F.col("row_id") % 2).cast("int"))
    shared = EV.Preparations()
    make = lambda name, **p: M.configure(name, p, ["x", "z"], ["kind"], 120.0, 3)
    table = EV.compare_models({n: (lambda n=n: make(n)) for n in ("logistic_regression", "majority_class")}, folds, k=2,
                              preparations=shared)
    found = T.random_search("logistic_regression", lambda p: make("logistic_regression", **p), {"C": [0.1, 1.0]}, folds, k=2,
                            preparations=shared)
    assert len(fits) == 2 and found.results.count() == 2
    alone = EV.cross_validate(lambda: make("logistic_regression"), folds, k=2)
    assert len(fits) == 4  # other folds may be meant by another call
    assert table.filter("model = 'logistic_regression'").first().cv_f1_macro_mean == alone["cv_f1_macro_mean"]
    other, _ = shared.fit(M.build_pipeline(_classifier(), ["x"], []), folds.filter("fold != 0"), 0)
    assert len(fits) == 5 and other.stages[0].fitted().keys() == {"x"}  # other columns: not shared
