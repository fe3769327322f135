"""Model report bundle: classification report, confusion table, built-in
and source-level importances and permutation importance for one fitted
model, as tables (written as CSV when an output folder is given)."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from strata.operators import evaluate as EV
from strata.operators import explain as XP
from strata.operators.models import class_of
from strata.sources import io as IO


@dataclass
class ReportBundle:
    report: DataFrame
    confusion: DataFrame
    importance: DataFrame
    aggregated_importance: DataFrame
    permutation_importance: DataFrame
    top_features: list


def model_report(model: PipelineModel, test: DataFrame, classes: Sequence, features: Sequence[str], *,
                 id_col: str, top_n: int = 5, repeats: int = 20, seed: int = 42,
                 output_dir: str | None = None) -> ReportBundle:
    pred = model.transform(test)
    conf = EV.confusion_counts(pred, "label_idx", "prediction", labels=[float(i) for i in range(len(classes))])
    conf = conf.withColumns({"label": class_of("label", classes), "predicted": class_of("predicted", classes)})
    report = EV.classification_report(conf)
    importance = XP.model_importance(model, pred)
    aggregated = XP.aggregate_importance(importance, features)
    permutation = XP.permutation_importance(model, test, features, id_col=id_col, repeats=repeats, seed=seed)
    top = [r.source for r in aggregated.limit(top_n).collect()]
    bundle = ReportBundle(report, conf, importance, aggregated, permutation, top)
    if output_dir:
        for name in ("report", "confusion", "importance", "aggregated_importance", "permutation_importance"):
            IO.write_csv(getattr(bundle, name), os.path.join(output_dir, name))
    return bundle
