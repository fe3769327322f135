"""Batch scoring: validate input, prepare features once, transform, add
probability/confidence columns, optionally evaluate against known labels,
summarize and write.

The model runs once: scored rows are written as they come out of it, the
checks of the probabilities are observed on that write, and everything after
(id checks, summaries, metrics, artifacts) reads the written predictions."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators import evaluate as EV
from strata.operators import quality as Q
from strata.operators import score as SC
from strata.session import checkpoint_dir
from strata.sources import io as IO


def score_batch(
    model: PipelineModel,
    df: DataFrame,
    classes: Sequence,
    *,
    id_col: str,
    features: Sequence[str],
    label: str | None = None,
    context: Sequence[str] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    validate: bool = True,
    check_ids: bool | None = None,
    allow_empty: bool = False,
    output: str | None = None,
) -> DataFrame:
    """Scored rows: id, context columns, PredictedClass, one probability
    column per class, confidence, second-highest, margin, low-confidence
    flag, and PredictionCorrect when ``label`` is present.

    The rows are written to ``output`` (by default a folder of their own under
    the shared checkpoint folder) and read back, so that nothing downstream
    runs the model again. ``validate`` checks that there are rows (unless
    ``allow_empty``), then probabilities and ids (null/duplicate), and raises
    after the write; ``check_ids=False`` skips the id check when the caller
    already verified them."""
    Q.require_columns(df, [id_col, *features], "scoring input")
    prepared = prepare(df) if prepare else df
    pred = model.transform(prepared)
    probs = SC.model_probabilities("probability")
    keep = [id_col, *[c for c in context if c in pred.columns]] + ([label] if label and label in pred.columns else [])
    pred = pred.select(*keep, probs.alias("_probs"))
    seen = Observation()
    if validate:
        pred = pred.observe(seen, *SC.probability_faults(F.col("_probs"), len(classes)))
    scored = SC.with_score_columns(pred, F.col("_probs"), classes).drop("_probs")
    if label and label in scored.columns:
        scored = SC.add_correctness(scored, label)
    path = output or os.path.join(checkpoint_dir(df.sparkSession), f"scored-{uuid.uuid4().hex}")
    schema = scored.schema
    scored.write.mode("overwrite").parquet(path)
    if validate:
        faults = seen.get
        if not faults["rows"] and not allow_empty:
            raise ValueError("scoring input must contain at least one row")
        SC.raise_faults(faults, len(classes))
    scored = df.sparkSession.read.schema(schema).parquet(path)
    if validate if check_ids is None else check_ids:
        Q.validate_ids(scored, id_col)
    return scored


def add_context_columns(scored: DataFrame, prepared: DataFrame, id_col: str, columns: Sequence[str],
                        preferred: Sequence[str] = ()) -> DataFrame:
    """Attach context columns from the prepared input by id (validated
    one-to-one left join), then put ``preferred`` columns first."""
    from strata.operators.filters import reorder_columns
    from strata.operators.joins import left_join_one_to_one
    ctx = prepared.select(id_col, *[c for c in columns if c in prepared.columns and c not in scored.columns])
    return reorder_columns(left_join_one_to_one(scored, ctx, [id_col]), [id_col, *preferred])


def prepare_for_scoring(raw: DataFrame, prepare: Callable[[DataFrame], DataFrame], id_col: str,
                        features: Sequence[str]) -> DataFrame:
    """Prepare features once and check the post-conditions in one
    aggregate: same row count, ids still unique, every feature present."""
    Q.require_columns(raw, [id_col], "scoring input")
    prepared = prepare(raw)
    Q.require_columns(prepared, features, "prepared scoring data")
    before = raw.agg(F.count(F.lit(1)).alias("n")).first().n
    if not before:
        raise ValueError("scoring input must contain at least one row")
    after = prepared.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(id_col).alias("ids"),
                         F.sum(F.col(id_col).isNull().cast("int")).alias("null_ids")).first()
    if after.n != before:
        raise ValueError(f"preparation changed the row count ({before} -> {after.n})")
    if after.null_ids:
        raise ValueError(f"{after.null_ids} rows have no identifier")
    if after.ids != after.n:
        raise ValueError("identifiers are not unique after preparation")
    return prepared


def evaluate_scored(scored: DataFrame, label: str, classes: Sequence) -> tuple[DataFrame, DataFrame]:
    """(metrics, classification report) against known labels; null or
    unknown labels are rejected."""
    EV.validate_labels(scored, label, classes)
    conf = EV.confusion_counts(scored, label, SC.PREDICTION, labels=list(classes))
    return EV.metrics_from_confusion(conf), EV.classification_report(conf)


def save_scoring_outputs(scored: DataFrame, output_dir: str, classes: Sequence, *,
                         metrics: DataFrame | None = None, report: DataFrame | None = None) -> dict:
    """Predictions (Parquet), run summary (JSON), class distribution and,
    when labels were known, metrics and the class report. An empty result
    is rejected before anything is written."""
    if scored.isEmpty():
        raise ValueError("no predictions to save")
    paths = {"predictions": os.path.join(output_dir, "predictions"),
             "summary": os.path.join(output_dir, "summary"),
             "class_distribution": os.path.join(output_dir, "class_distribution")}
    scored.write.mode("overwrite").parquet(paths["predictions"])
    SC.prediction_summary(scored, classes).write.mode("overwrite").json(paths["summary"])
    IO.write_csv(SC.class_distribution(scored), paths["class_distribution"])
    if metrics is not None:
        paths["metrics"] = os.path.join(output_dir, "metrics")
        metrics.write.mode("overwrite").json(paths["metrics"])
    if report is not None:
        paths["classification_report"] = os.path.join(output_dir, "classification_report")
        IO.write_csv(report, paths["classification_report"])
    return paths
