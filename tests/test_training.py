from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import pytest

from strata.plans.scoring import evaluate_scored, prepare_for_scoring, save_scoring_outputs, score_batch
from strata.plans.testbed_models import CATEGORICAL, NUMERIC, embedding_frame
from strata.plans.training import TrainingConfig, load_model, run_training


def test_training_flow_end_to_end(spark, tmp_path):
    data = embedding_frame(spark, "/root/testdata/sf0.001").withColumn("label", F.col("label") % 3)
    cfg = TrainingConfig(label="label", id_col="vec_id", numeric=NUMERIC[:16], categorical=CATEGORICAL, folds=3,
                         tuning_iterations=2, candidates=("logistic_regression", "majority_class"),
                         output_dir=str(tmp_path))
    res = run_training(data, cfg)
    names = [r.model for r in res.comparison.collect()]
    assert sorted(names) == ["logistic_regression", "majority_class"]
    assert res.model_name == names[0]
    assert res.variant in ("baseline", "tuned")
    n = data.count()
    m = res.holdout_metrics.first()
    assert 0.0 <= m.accuracy <= 1.0 and m.rows == -(-n // 5)  # ceil(0.2 * n)
    assert (tmp_path / "model_metadata.json").exists()
    model = load_model(str(tmp_path / "model"))
    scored = score_batch(model, data, res.classes, id_col="vec_id", features=[*cfg.numeric, *cfg.categorical],
                         label="label")
    assert scored.count() == n
    metrics, report = evaluate_scored(scored, "label", res.classes)
    assert metrics.first().rows == n
    assert {r.label for r in report.collect()} >= {"accuracy", "macro avg", "weighted avg"}
    paths = save_scoring_outputs(scored, str(tmp_path / "scored"), res.classes, metrics=metrics, report=report)
    assert spark.read.parquet(paths["predictions"]).count() == n
    with pytest.raises(ValueError):
        save_scoring_outputs(scored.limit(0), str(tmp_path / "empty"), res.classes)


class _Fixed:
    """A model whose probabilities are given with the rows, counting the rows it scores."""

    def __init__(self, spark):
        self.seen = spark.sparkContext.accumulator(0)

    def transform(self, df):
        seen = self.seen

        def tell(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(tell, df.schema).withColumn("probability", array_to_vector("probs"))


def _scoring_rows(spark, probs):
    rows = [(i, [float(x) for x in p], "a" if i % 2 else "b", f"x{i}") for i, p in enumerate(probs)]
    return spark.createDataFrame(rows, "id long, probs array<double>, cls string, extra string")


def test_model_runs_once(spark, tmp_path):
    model = _Fixed(spark)
    data = _scoring_rows(spark, [(0.7, 0.3)] * 40 + [(0.2, 0.8)] * 60).repartition(3)
    scored = score_batch(model, data, ["a", "b"], id_col="id", features=["probs"], label="cls", context=["extra"])
    metrics, report = evaluate_scored(scored, "cls", ["a", "b"])
    save_scoring_outputs(scored, str(tmp_path / "out"), ["a", "b"], metrics=metrics, report=report)
    assert scored.count() == 100 and scored.columns[:3] == ["id", "extra", "cls"]
    assert model.seen.value == 100  # checks, id check, metrics and artifacts read what was written


@pytest.mark.parametrize("probs, message", [
    ([], "at least one row"), ([(0.5, 0.5), (1.0,)], "class probabilities"),
    ([(0.5, float("nan"))], "non-finite"), ([(0.5, 0.6)], "sum to one")])
def test_bad_scores_are_rejected(spark, probs, message):
    with pytest.raises(ValueError, match=message):
        score_batch(_Fixed(spark), _scoring_rows(spark, probs), ["a", "b"], id_col="id", features=["probs"])


def test_repeated_ids_are_rejected(spark):
    data = _scoring_rows(spark, [(0.5, 0.5)] * 2)
    with pytest.raises(ValueError, match="duplicate identifiers"):
        score_batch(_Fixed(spark), data.union(data), ["a", "b"], id_col="id", features=["probs"])
    with pytest.raises(ValueError, match="missing identifiers"):
        score_batch(_Fixed(spark), data.withColumn("id", F.lit(None).cast("long")), ["a", "b"], id_col="id", features=["probs"])


def test_prepare_for_scoring_rejects_what_breaks_the_rows(spark):
    data = _scoring_rows(spark, [(0.5, 0.5)] * 4)
    same = lambda d: d
    assert prepare_for_scoring(data, same, "id", ["probs"]).count() == 4
    for prepare, message in ((lambda d: d.limit(3), "row count"), (lambda d: d.withColumn("id", F.lit(1)), "not unique"),
                             (lambda d: d.withColumn("id", F.lit(None)), "no identifier"), (lambda d: d.drop("probs"), "probs")):
        with pytest.raises(ValueError, match=message):
            prepare_for_scoring(data, prepare, "id", ["probs"])
    with pytest.raises(ValueError, match="at least one row"):
        prepare_for_scoring(data.limit(0), same, "id", ["probs"])
