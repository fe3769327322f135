"""Training flow: validate, split, compare candidates by CV, refit the best,
tune it, keep the tuned variant only if strictly better, evaluate once on
the holdout, persist model and tables."""

from __future__ import annotations

import datetime as _dt
import json
import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from strata.operators import evaluate as EV
from strata.operators import models as M
from strata.operators import quality as Q
from strata.operators import split as SP
from strata.operators import tune as T
from strata.session import cut_lineage


@dataclass
class TrainingConfig:
    label: str
    id_col: str
    numeric: Sequence[str]
    categorical: Sequence[str]
    test_fraction: float = 0.2
    folds: int = 5
    seed: int = 42
    tune: bool = True
    tuning_iterations: int = T.DEFAULT_ITERATIONS
    num_trees: int = 500
    candidates: Sequence[str] = ("random_forest", "logistic_regression", "majority_class")
    output_dir: str | None = None
    parallelism: int = 1
    exact_split: bool = True  # False: shuffle-free hash split/folds (shares hold in expectation)


@dataclass
class TrainingResult:
    model: PipelineModel
    model_name: str
    variant: str
    classes: list
    comparison: DataFrame
    tuning: T.TuningResult | None
    holdout_metrics: DataFrame
    holdout_report: DataFrame
    holdout_confusion: DataFrame
    metadata: dict = field(default_factory=dict)


def prepare_labels(df: DataFrame, label: str, classes: Sequence) -> DataFrame:
    return df.withColumn("label_idx", M.label_index(label, classes))


def run_training(df: DataFrame, cfg: TrainingConfig) -> TrainingResult:
    Q.assert_trainable(df, cfg.label, [*cfg.numeric, *cfg.categorical])
    classes = M.sorted_classes(df, cfg.label)
    k = len(classes)
    data = prepare_labels(df.select(cfg.id_col, cfg.label, *cfg.numeric, *cfg.categorical), cfg.label, classes)
    split = SP.stratified_split(data, cfg.label, cfg.id_col, cfg.test_fraction, cfg.seed, exact=cfg.exact_split)
    train_counts = SP.class_counts(split.filter("NOT is_test"), cfg.label)
    train = SP.with_class_weights(split.filter("NOT is_test"), cfg.label, counts=train_counts).drop("is_test")
    test = split.filter("is_test").drop("is_test")
    # the fold table is reused by every CV fit: materialize it once in the
    # shared checkpoint folder (survives executor loss, short lineage)
    folds = cut_lineage(SP.stratified_folds(train, cfg.label, cfg.id_col, cfg.folds, cfg.seed,
                                            exact=cfg.exact_split))
    n_weighted = float(sum(train_counts.values()))

    def factory(name, params=None):
        if name == "random_forest" and params is None:
            params = {"numTrees": cfg.num_trees}
        return lambda: M.configure(name, params or {}, cfg.numeric, cfg.categorical, n_weighted, k)

    # the rows to refit on are the fold table's; preparation is fitted once a fold and once to all of them
    train, preparations = folds.drop("fold"), EV.Preparations()
    comparison = EV.compare_models({n: factory(n) for n in cfg.candidates}, folds, k=cfg.folds,
                                   parallelism=cfg.parallelism, preparations=preparations)
    best_row = comparison.first()
    best = best_row["model"]
    model, _ = preparations.fit(factory(best)(), train, "all")
    variant, tuning = "baseline", None
    if cfg.tune and best in M.PARAMETER_DISTRIBUTIONS:
        tuning = T.random_search(best, lambda p: M.configure(best, p, cfg.numeric, cfg.categorical, n_weighted, k),
                                 M.PARAMETER_DISTRIBUTIONS[best], folds, k=cfg.folds, n_iter=cfg.tuning_iterations,
                                 seed=cfg.seed, parallelism=cfg.parallelism, preparations=preparations)
        if T.keep_tuned(best_row["cv_f1_macro_mean"], tuning):
            model, _ = preparations.fit(factory(best, tuning.best_params)(), train, "all")
            variant = "tuned"
    pred = model.transform(test)
    conf = EV.confusion_counts(pred, "label_idx", "prediction", labels=[float(i) for i in range(k)])
    conf = conf.withColumns({"label": M.class_of("label", classes), "predicted": M.class_of("predicted", classes)})
    metrics = EV.metrics_from_confusion(conf)
    report = EV.classification_report(conf)
    metadata = {"model_name": best, "variant": variant, "target_column": cfg.label,
                "feature_columns": [*cfg.numeric, *cfg.categorical], "classes": classes,
                "training_rows": n_weighted, "created_utc": _dt.datetime.now(_dt.UTC).isoformat()}
    result = TrainingResult(model, best, variant, classes, comparison, tuning, metrics, report, conf, metadata)
    if cfg.output_dir:
        save_training_outputs(result, cfg.output_dir)
    return result


def save_training_outputs(result: TrainingResult, output_dir: str) -> None:
    """Model (whole pipeline), comparison, tuning, holdout tables; the
    small metadata document is written as one JSON file."""
    result.model.write().overwrite().save(os.path.join(output_dir, "model"))
    result.comparison.write.mode("overwrite").option("header", True).option("escape", '"').csv(os.path.join(output_dir, "model_comparison"))
    if result.tuning is not None:
        result.tuning.results.write.mode("overwrite").option("header", True).option("escape", '"').csv(
            os.path.join(output_dir, "search_results"))
    result.holdout_report.write.mode("overwrite").option("header", True).option("escape", '"').csv(
        os.path.join(output_dir, "classification_report"))
    result.holdout_metrics.write.mode("overwrite").json(os.path.join(output_dir, "holdout_metrics"))
    from strata.sources.io import write_text_file
    write_text_file(result.comparison.sparkSession, os.path.join(output_dir, "model_metadata.json"),
                    json.dumps(result.metadata, indent=2, default=str))


def load_model(path: str) -> PipelineModel:
    """The saved pipeline; the path is looked up in its own (Hadoop) filesystem."""
    from pyspark.sql import SparkSession

    from strata.sources.io import _exists
    if not _exists(SparkSession.builder.getOrCreate(), path):
        raise FileNotFoundError(f"model not found: {path}")
    return PipelineModel.load(path)
