"""Classification metrics computed in Spark from confusion counts.

Predictions are reduced by one ``groupBy(label, prediction)`` (map-side
combined) to at most k^2 cells; every metric is an aggregate over that
tiny table. Nothing row-level reaches the driver.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.split import MAX_CLASSES
from strata.session import cut_lineage

REPORT_COLUMNS = ("label", "precision", "recall", "f1-score", "support")


def resolve_labels(df: DataFrame, label: str, prediction: str) -> list:
    """Sorted union of true and predicted labels; more than ``MAX_CLASSES`` are refused."""
    rows = (df.select(F.inline(F.array(F.struct(F.col(label).alias("v")), F.struct(F.col(prediction).alias("v")))))
            .filter(F.col("v").isNotNull()).distinct().limit(MAX_CLASSES + 1).collect())
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"'{label}' and '{prediction}' have more than {MAX_CLASSES} distinct values")
    return sorted(r.v for r in rows)


def confusion_counts(df: DataFrame, label: str, prediction: str, labels: Sequence | None = None,
                     group: Sequence[str] = ()) -> DataFrame:
    """Dense (group..., label, predicted, count) grid in the fixed label
    order, zeros included. ``group`` computes one grid per group (e.g. per
    fold); the grid of (group, label, predicted) keys is built from the
    observed groups and the label list, never by joining rows. Labels that are
    not given are looked up in the counts, so that ``df`` is computed once."""
    counts = df.groupBy(*group, F.col(label).alias("label"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count"))
    if labels is None:
        counts = cut_lineage(counts)
        labels = resolve_labels(counts, "label", "predicted")
    every = F.array(*[F.lit(a) for a in labels])
    keys = counts.select(*group).distinct() if group else df.sparkSession.range(1)
    keys = keys.select(*group, F.explode(every).alias("label")).select("*", F.explode(every).alias("predicted"))
    grid = keys.join(counts, [*group, "label", "predicted"], "left")
    return grid.select(*group, "label", "predicted", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def normalize_confusion(conf: DataFrame, normalize: str | None = None, decimals: int = 4,
                        group: Sequence[str] = ()) -> DataFrame:
    """``None`` counts; ``true`` rows sum to 1; ``pred`` columns sum to 1;
    ``all`` the table sums to 1 (windows over the k^2 cells)."""
    if normalize is None:
        return conf
    parts = {"true": [*group, "label"], "pred": [*group, "predicted"], "all": list(group)}
    if normalize not in parts:
        raise ValueError("normalize must be None, 'true', 'pred' or 'all'")
    total = F.sum("count").over(Window.partitionBy(*parts[normalize]))
    return conf.withColumn("value", F.round(F.coalesce(F.try_divide(F.col("count"), total), F.lit(0.0)), decimals))


def _per_class(conf: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    tp = conf.filter(F.col("label") == F.col("predicted")).select(*group, "label", F.col("count").alias("tp"))
    support = conf.groupBy(*group, "label").agg(F.sum("count").alias("support"))
    predicted = conf.groupBy(*group, F.col("predicted").alias("label")).agg(F.sum("count").alias("predicted_total"))
    pc = tp.join(support, [*group, "label"]).join(predicted, [*group, "label"])
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted_total")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    pc = pc.withColumns({"precision": p, "recall": r})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                    F.lit(0.0))
    return pc.withColumn("f1", f1)


def metrics_from_confusion(conf: DataFrame, group: Sequence[str] = (), decimals: int | None = None) -> DataFrame:
    """accuracy, balanced accuracy (mean recall over classes present in the
    truth), macro F1 (zero division -> 0) and row count per group."""
    pc = _per_class(conf, group)
    out = pc.groupBy(*group).agg(
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("f1_macro"),
        F.sum("support").cast("long").alias("rows"))
    if decimals is not None:
        out = out.select(*group, *[F.round(c, decimals).alias(c) for c in ("accuracy", "balanced_accuracy", "f1_macro")],
                         "rows")
    return out


def classification_report(conf: DataFrame, decimals: int = 4) -> DataFrame:
    """Tidy report: one row per class, then ``accuracy`` (value in
    f1-score, support = total), ``macro avg`` and ``weighted avg``."""
    pc = _per_class(conf)
    rd = lambda c: F.round(c, decimals)
    per = pc.select(F.col("label").cast("string").alias("label"), rd(F.col("precision")).alias("precision"),
                    rd(F.col("recall")).alias("recall"), rd(F.col("f1")).alias("f1-score"),
                    F.col("support").cast("long").alias("support"))
    total = F.sum("support")
    summary = pc.agg(
        F.try_divide(F.sum("tp"), total).alias("acc"), total.alias("n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.try_divide(F.sum(F.col("precision") * F.col("support")), total).alias("wp"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), total).alias("wr"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), total).alias("wf"))
    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("label"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.alias("f1-score"),
                        F.col("n").cast("long").alias("support"))
    rows = F.array(row("accuracy", F.lit(None), F.lit(None), rd(F.col("acc"))),
                   row("macro avg", rd(F.col("mp")), rd(F.col("mr")), rd(F.col("mf"))),
                   row("weighted avg", rd(F.col("wp")), rd(F.col("wr")), rd(F.col("wf"))))
    return per.unionByName(summary.select(F.inline(rows)))


_REPORT_ALIASES = {
    "label": ("label", "class", "", "_c0", "index", "Unnamed: 0"),
    "precision": ("precision",),
    "recall": ("recall",),
    "f1-score": ("f1-score", "f1_score", "f1", "f1score"),
    "support": ("support", "count"),
}


def normalize_classification_report(report: DataFrame) -> DataFrame:
    """Accept report tables written in other layouts (label column named
    ``class``/unnamed, ``f1_score``/``f1``, ``count``) and return the fixed
    column order label, precision, recall, f1-score, support. Missing
    metric columns become nulls."""
    lower = {c.lower(): c for c in report.columns}
    cols = []
    for target, aliases in _REPORT_ALIASES.items():
        found = next((lower[a.lower()] for a in aliases if a.lower() in lower), None)
        dtype = "string" if target == "label" else ("long" if target == "support" else "double")
        cols.append((F.col(f"`{found}`") if found else F.lit(None)).cast(dtype).alias(target))
    return report.select(*cols)


def validate_labels(df: DataFrame, label: str, known: Sequence) -> None:
    """External evaluation guard: no null and no unknown true labels."""
    row = df.agg(F.sum(F.col(label).isNull().cast("int")).alias("nulls"),
                 F.sum((F.col(label).isNotNull() & ~F.col(label).isin(list(known))).cast("int")).alias("unknown")).first()
    if row.nulls:
        raise ValueError(f"target column '{label}' contains {row.nulls} missing values")
    if row.unknown:
        bad = [r[0] for r in df.filter(~F.col(label).isin(list(known))).select(label).distinct().limit(10).collect()]
        raise ValueError(f"target column '{label}' contains labels unknown to the model: {sorted(bad)}")


def metrics_table(metrics: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
    """Wide metric row(s) -> long (metric, value)."""
    value_cols = [c for c in metrics.columns if c not in id_cols]
    return metrics.unpivot(list(id_cols), value_cols, "metric", "value")


def compare_metrics(internal: DataFrame, external: DataFrame, decimals: int = 4) -> DataFrame:
    """Metrics present in both long tables: internal, external, change."""
    a = internal.select("metric", F.col("value").cast("double").alias("internal"))
    b = external.select("metric", F.col("value").cast("double").alias("external"))
    return a.join(b, "metric").withColumn("change", F.round(F.col("external") - F.col("internal"), decimals))


# ---------------------------------------------------------------------------
# Cross-validation
# ---------------------------------------------------------------------------

def _alike(stage) -> tuple:
    """What a preparation stage does: its kind and parameters, without a default name made of its uid."""
    own = stage.extractParamMap().items()
    unused = {"outputCol"} if any(p.name == "outputCols" and stage.isSet(p) for p, _ in own) else set()
    return type(stage).__name__, *sorted((p.name, repr(v)) for p, v in own if p.name not in unused)


class Preparations:
    """Fits pipelines stage by stage as ``Pipeline.fit`` does, the stages before
    the classifier once for each data set: candidates and settings compared on
    the same folds share what is fitted to a fold. Only fitted values are kept."""

    def __init__(self):
        self._fitted: dict = {}

    def fit(self, pipeline: Pipeline, data: DataFrame, at) -> tuple[PipelineModel, float]:
        """The fitted pipeline and its seconds, those of a shared preparation
        included. ``at`` names the data set, such as a fold."""
        *steps, classifier = pipeline.getStages()
        key = (at, *map(_alike, steps))
        if key not in self._fitted:
            t0 = time.perf_counter()
            self._fitted[key] = Pipeline(stages=steps).fit(data), time.perf_counter() - t0
        prepared, seconds = self._fitted[key]
        t0 = time.perf_counter()
        fitted = Pipeline(stages=[classifier]).fit(prepared.transform(data))
        return PipelineModel([*prepared.stages, *fitted.stages]), seconds + time.perf_counter() - t0


def cross_validate(
    pipeline_factory: Callable[[], Pipeline],
    folds: DataFrame,
    *,
    k: int,
    fold_col: str = "fold",
    label_col: str = "label_idx",
    prediction_col: str = "prediction",
    parallelism: int = 1,
    train_scores: bool = False,
    preparations: Preparations | None = None,
) -> dict:
    """Fit on k-1 folds, score the held-out fold, for every fold; metrics
    of all folds come from one grouped confusion table. ``train_scores`` also
    scores each model on the folds it was fitted to, in the same table. With
    ``parallelism`` > 1 fold fits are submitted from that many driver
    threads and Spark runs their jobs concurrently (as
    ``CrossValidator(parallelism=...)`` does); each concurrent forest fit
    needs its own split-statistics memory, so size it to the executors.
    Pass the same ``preparations`` for all pipelines that are compared on the
    same folds: what is alike in them is fitted once a fold.
    Returns means, population stds (``cv_...`` of held-out folds, ``train_...``
    of fitted ones) and mean fit/score seconds."""
    preparations = preparations or Preparations()

    def run_fold(f: int):
        train = folds.filter(F.col(fold_col) != f)
        test = folds.filter(F.col(fold_col) == f)
        model, fit_time = preparations.fit(pipeline_factory(), train, f)
        t0 = time.perf_counter()
        pred = model.transform(test).select(F.lit("test").alias("_part"), F.lit(f).alias(fold_col), label_col, prediction_col)
        if train_scores:
            own = model.transform(train).select(F.lit("train").alias("_part"), F.lit(f).alias(fold_col), label_col, prediction_col)
            pred = pred.unionByName(own)
        return pred, fit_time, time.perf_counter() - t0

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, k))) as pool:
        runs = list(pool.map(run_fold, range(k)))
    allpred = runs[0][0]
    for pred, _, _ in runs[1:]:
        allpred = allpred.unionByName(pred)
    groups = ["_part", fold_col]
    per_fold = metrics_from_confusion(confusion_counts(allpred, label_col, prediction_col, group=groups), group=groups)
    measured = ("accuracy", "balanced_accuracy", "f1_macro")
    parts = {"test": "cv", "train": "train"} if train_scores else {"test": "cv"}
    agg = per_fold.agg(*[f(F.when(F.col("_part") == part, F.col(m))).alias(f"{prefix}_{m}_{kind}")
                         for part, prefix in parts.items() for kind, f in (("mean", F.avg), ("std", F.stddev_pop))
                         for m in measured])
    t0 = time.perf_counter()
    result = agg.first().asDict()
    score_total = time.perf_counter() - t0
    result["fit_time_mean"] = sum(r[1] for r in runs) / k
    result["score_time_mean"] = (sum(r[2] for r in runs) + score_total) / k
    return result


def compare_models(candidates: dict[str, Callable[[], Pipeline]], folds: DataFrame, *, k: int,
                   fold_col: str = "fold", parallelism: int = 1, preparations: Preparations | None = None) -> DataFrame:
    """Cross-validate every candidate on the same folds; ordered by macro
    F1, balanced accuracy, accuracy (descending) — the first row wins."""
    rows, preparations = [], preparations or Preparations()
    for name, factory in candidates.items():
        res = cross_validate(factory, folds, k=k, fold_col=fold_col, parallelism=parallelism, preparations=preparations)
        rows.append({"model": name, **res})
    spark = folds.sparkSession
    cols = ["model", "cv_accuracy_mean", "cv_accuracy_std", "cv_balanced_accuracy_mean", "cv_balanced_accuracy_std",
            "cv_f1_macro_mean", "cv_f1_macro_std", "fit_time_mean", "score_time_mean"]
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], cols)
    return df.orderBy(F.col("cv_f1_macro_mean").desc(), F.col("cv_balanced_accuracy_mean").desc(),
                      F.col("cv_accuracy_mean").desc(), "model")


COMPARISON_COLUMNS = ("model", "cv_f1_macro_mean", "cv_f1_macro_std", "cv_balanced_accuracy_mean",
                      "cv_balanced_accuracy_std", "cv_accuracy_mean", "cv_accuracy_std", "fit_time_mean",
                      "score_time_mean")


def format_comparison(comparison: DataFrame, decimals: int = 4) -> DataFrame:
    """Comparison table for reporting: fixed column order, rounded values,
    best model first."""
    cols = [F.col("model")] + [F.round(c, decimals).alias(c) for c in COMPARISON_COLUMNS[1:] if c in comparison.columns]
    return comparison.select(*cols).orderBy(F.col("cv_f1_macro_mean").desc(), F.col("cv_balanced_accuracy_mean").desc(),
                                            F.col("cv_accuracy_mean").desc(), "model")


def select_best(comparison: DataFrame) -> str:
    return comparison.first()["model"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
