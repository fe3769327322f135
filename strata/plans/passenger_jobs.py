"""Passenger jobs: prepare a raw CSV into Parquet, train the class model,
score new passengers (evaluating when the class is known). Each job reads
and writes through Spark; only small summaries reach the driver."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators.filters import reorder_columns
from strata.plans.scoring import evaluate_scored, prepare_for_scoring, save_scoring_outputs, score_batch
from strata.plans.training import TrainingConfig, TrainingResult, load_model, run_training
from strata.presets import passenger as P
from strata.sources import io as IO

CONTEXT = ("Name", "Sex", "Age", "Fare", "Embarked")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw CSV with its header, every column as text (types are then
    standardized explicitly); scoring files may lack ``Survived``/``Pclass``."""
    df = IO.read_csv(spark, path, name="passenger data")
    return df.select(*[F.col(c).cast("string") for c in df.columns])


def prepare_data_job(spark: SparkSession, raw_csv: str, processed_parquet: str) -> dict:
    """Validate, standardize, add features, write Parquet; return the
    preparation summary and the raw quality report (small tables)."""
    raw = read_raw(spark, raw_csv)
    prepared = P.prepare_passenger_data(raw)
    IO.write_parquet(prepared, processed_parquet)
    written = IO.read_parquet(spark, processed_parquet)
    summary = Q.preparation_summary(raw, written).first().asDict()
    # the whole report is a table beside the data; what reaches the driver is sized by the schema:
    # unexpected values, one row each, may be as many as the rows
    quality_path = IO.write_csv(P.quality_report(P.standardize(raw)), f"{processed_parquet.rstrip('/')}_quality")
    report = spark.read.option("header", True).option("escape", '"').csv(quality_path)
    quality = [r.asDict() for r in report.filter("section <> 'unexpected'").collect()]
    return {"summary": summary, "quality": quality, "quality_path": quality_path}


def train_job(spark: SparkSession, processed_parquet: str, output_dir: str, **config) -> TrainingResult:
    """Train, tune and evaluate the class model on the prepared table."""
    data = IO.read_parquet(spark, processed_parquet)
    cfg = TrainingConfig(label=P.TARGET, id_col=P.ID, numeric=list(P.NUMERIC_FEATURES),
                         categorical=list(P.CATEGORICAL_FEATURES), output_dir=output_dir, **config)
    return run_training(data, cfg)


def predict_job(spark: SparkSession, input_csv: str, model_dir: str, output_dir: str) -> dict:
    """Score a raw passenger CSV: prepare once (row count and ids checked),
    predict with probability/confidence columns, attach context, evaluate
    against ``Pclass`` when present, write the artifacts."""
    meta = json.loads(spark.read.text(os.path.join(model_dir, "model_metadata.json"), wholetext=True).first()[0])
    classes = meta["classes"]
    model = load_model(os.path.join(model_dir, "model"))
    raw = read_raw(spark, input_csv)
    features = [*P.NUMERIC_FEATURES, *P.CATEGORICAL_FEATURES]
    prepared = prepare_for_scoring(raw, lambda d: P.prepare_passenger_data(d, required=P.SCORING_REQUIRED), P.ID,
                                   features)
    labelled = P.TARGET in prepared.columns
    # ids were verified (non-null, unique) by prepare_for_scoring
    scored = score_batch(model, prepared, classes, id_col=P.ID, features=features,
                         label=P.TARGET if labelled else None, context=[c for c in CONTEXT if c != P.TARGET],
                         check_ids=False)
    scored = reorder_columns(scored, [P.ID, *CONTEXT])
    metrics = report = None
    if labelled:
        metrics, report = evaluate_scored(scored, P.TARGET, classes)
    paths = save_scoring_outputs(scored, output_dir, classes, metrics=metrics, report=report)
    return {"paths": paths, "labelled": labelled,
            "metrics": metrics.first().asDict() if metrics is not None else None}
