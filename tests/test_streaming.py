from pyspark.sql import functions as F

from strata.operators import models as M
from strata.operators import split as SP
from strata.plans.testbed_models import CATEGORICAL, NUMERIC, embedding_frame
from strata.streaming.incremental import score_stream


def test_incremental_scoring(spark, tmp_path):
    data = embedding_frame(spark, "/root/testdata/sf0.001")
    classes = M.sorted_classes(data, "label")
    train = SP.with_class_weights(data.withColumn("label_idx", M.label_index("label", classes)), "label")
    model = M.configure("logistic_regression", {"C": 1.0}, NUMERIC, CATEGORICAL, float(train.count()),
                        len(classes)).fit(train)
    src = str(tmp_path / "incoming")
    data.drop("label").repartition(3).write.parquet(src)
    q = score_stream(spark, model, classes, source_dir=src, schema=data.drop("label").schema,
                     output_dir=str(tmp_path / "scored"), checkpoint_dir=str(tmp_path / "ckpt"),
                     id_col="vec_id", features=[*NUMERIC, *CATEGORICAL])
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "scored"))
    assert out.count() == data.count()
    # a restart on the same checkpoint finds no new files: nothing is scored twice
    q2 = score_stream(spark, model, classes, source_dir=src, schema=data.drop("label").schema,
                      output_dir=str(tmp_path / "scored"), checkpoint_dir=str(tmp_path / "ckpt"),
                      id_col="vec_id", features=[*NUMERIC, *CATEGORICAL])
    q2.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "scored")).count() == data.count()
    assert out.filter(F.abs(F.col("PredictionConfidence") - F.greatest(
        *[F.col(f"ProbabilityClass{c}") for c in classes])) > 1e-12).count() == 0
