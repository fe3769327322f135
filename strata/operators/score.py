"""Batch scoring columns and scored-run summaries.

From a probability array (or Spark ML ``probability`` vector): predicted
class, one ``ProbabilityClass<label>`` column per class, confidence (max),
second-highest probability, margin and a low-confidence flag. All are
array expressions inside codegen; checks are one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import LOW_CONFIDENCE_THRESHOLD, confidence_band

PREDICTION = "PredictedClass"
CONFIDENCE = "PredictionConfidence"
SECOND = "SecondHighestProbability"
MARGIN = "ProbabilityMargin"
LOW = "LowConfidence"


def probability_column_name(label) -> str:
    return f"ProbabilityClass{label}"


def with_score_columns(
    df: DataFrame,
    probabilities: Column,
    classes: Sequence,
    *,
    threshold: float = LOW_CONFIDENCE_THRESHOLD,
    decimals: int | None = None,
) -> DataFrame:
    """Add prediction + probability columns. ``probabilities`` is an
    array<double> aligned with ``classes``; ties -> first class."""
    arr = F.col("_p")
    rd = (lambda c: F.round(c, decimals)) if decimals is not None else (lambda c: c)
    out = df.withColumn("_p", probabilities)
    best = F.array_position(arr, F.array_max(arr))
    cols = {PREDICTION: F.try_element_at(F.array(*[F.lit(c) for c in classes]), best.cast("int"))}
    for i, c in enumerate(classes):
        cols[probability_column_name(c)] = rd(F.get(arr, F.lit(i)))
    cols[CONFIDENCE] = rd(F.array_max(arr))
    cols[SECOND] = rd(F.try_element_at(F.array_sort(arr), F.lit(-2))) if len(classes) >= 2 else F.lit(0.0)
    out = out.withColumns(cols)
    out = out.withColumns({MARGIN: rd(F.col(CONFIDENCE) - F.col(SECOND)),
                           LOW: F.array_max(arr) < F.lit(threshold)})
    return out.drop("_p")


def model_probabilities(prob_col: str = "probability") -> Column:
    """Spark ML probability vector -> array<double>."""
    return vector_to_array(F.col(prob_col))


def probability_faults(probabilities: Column, n_classes: int, atol: float = 1e-6) -> list[Column]:
    """Aggregates for one pass, or for ``observe``: rows, and those with another
    number of probabilities, non-finite ones, or a sum off 1 by over ``atol``."""
    total = F.aggregate(probabilities, F.lit(0.0), lambda acc, x: acc + x)
    finite = F.forall(probabilities, lambda x: ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(probabilities) != n_classes).alias("shape"),
            F.count_if(~finite).alias("nonfinite"), F.count_if(F.abs(total - 1.0) > atol).alias("badsum")]


def raise_faults(faults: dict, n_classes: int) -> None:
    if faults["shape"]:
        raise ValueError(f"{faults['shape']} rows do not have {n_classes} class probabilities")
    if faults["nonfinite"]:
        raise ValueError(f"{faults['nonfinite']} rows contain non-finite probabilities")
    if faults["badsum"]:
        raise ValueError(f"{faults['badsum']} rows have probabilities that do not sum to one")


def check_probabilities(df: DataFrame, probabilities: Column, n_classes: int, atol: float = 1e-6) -> None:
    """Raise unless every row has ``n_classes`` finite probabilities
    summing to 1 within ``atol`` (one aggregate)."""
    raise_faults(df.agg(*probability_faults(probabilities, n_classes, atol)).first().asDict(), n_classes)


def confidence_from_columns(df: DataFrame, prob_cols: Sequence[str] | None = None) -> Column:
    """Confidence derived from the probability columns when absent."""
    prob_cols = list(prob_cols or [c for c in df.columns if c.startswith("ProbabilityClass")])
    return F.greatest(*[F.col(c) for c in prob_cols]) if len(prob_cols) > 1 else F.col(prob_cols[0])


def with_confidence_band(df: DataFrame) -> DataFrame:
    return df.withColumn("ConfidenceBand", confidence_band(CONFIDENCE))


def probabilities_long(df: DataFrame, id_col: str, classes: Sequence, class_names: dict | None = None) -> DataFrame:
    """(id, class, class_name, probability) rows, sorted by id then
    probability descending."""
    cols = [probability_column_name(c) for c in classes]
    long = df.select(id_col, *cols).unpivot([id_col], cols, "column", "probability")
    cls = F.regexp_replace("column", "^ProbabilityClass", "")
    long = long.withColumn("class", cls).drop("column")
    if class_names:
        from strata.functions.exprs import recode
        long = long.withColumn("class_name", F.coalesce(recode("class", {str(k): v for k, v in class_names.items()}),
                                                        F.concat(F.lit("Class "), F.col("class"))))
    return long.orderBy(id_col, F.col("probability").desc(), "class")


def prediction_summary(scored: DataFrame, classes: Sequence, *, threshold: float = LOW_CONFIDENCE_THRESHOLD,
                       decimals: int = 4) -> DataFrame:
    """One row: rows, mean/median/min/max confidence, low-confidence count
    and percent (one aggregate)."""
    from strata.operators.quantiles import quantiles_long
    conf = F.col(CONFIDENCE)
    med = quantiles_long(scored, [CONFIDENCE], [0.5]).select("value")
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg(conf), decimals).alias("mean_confidence"),
        F.round(med.scalar(), decimals).alias("median_confidence"),
        F.round(F.min(conf), decimals).alias("min_confidence"),
        F.round(F.max(conf), decimals).alias("max_confidence"),
        F.sum((conf < threshold).cast("int")).cast("long").alias("low_confidence_count"),
        F.round(F.lit(100.0) * F.avg((conf < threshold).cast("double")), 2).alias("low_confidence_percent"))


def class_distribution(scored: DataFrame, decimals: int = 2) -> DataFrame:
    """Predicted rows per class with percentage of all scored rows."""
    from strata.operators.cohort import share_of_total
    return share_of_total(scored, F.col(PREDICTION).alias("predicted_class"), count_name="rows",
                          share_name="percent", decimals=decimals)


def add_correctness(scored: DataFrame, label: str) -> DataFrame:
    """``PredictionCorrect``: prediction equals the known label."""
    return scored.withColumn("PredictionCorrect", F.col(PREDICTION) == F.col(label))
