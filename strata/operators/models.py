"""Candidate classifiers as Spark ML pipelines.

Labels are arbitrary sortable values (e.g. classes 1, 2, 3); they are mapped
to indices 0..k-1 in sorted order for Spark ML (``label_index``) and back
(``class_of``). Balanced class weights enter through ``weightCol``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from itertools import chain

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.forest import ForestClassifier
from strata.operators.mlprep import preprocessing_stages
from strata.operators.split import MAX_CLASSES
from strata.session import checkpoint_dir

RANDOM_STATE = 42
MAX_TREE_DEPTH = 30  # Spark's limit; deeper (or unlimited) trees are capped


def sorted_classes(df: DataFrame, label: str) -> list:
    """Distinct non-null labels, sorted: one row per class to the driver. A column
    of more than ``MAX_CLASSES`` values is no class label and is refused."""
    rows = df.select(label).filter(F.col(label).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"column '{label}' has more than {MAX_CLASSES} distinct values")
    return sorted(r[0] for r in rows)


def label_index(label: str, classes: Sequence) -> Column:
    m = F.create_map(*chain.from_iterable((F.lit(c), F.lit(float(i))) for i, c in enumerate(classes)))
    return m[F.col(label)]


def class_of(index_col: str | Column, classes: Sequence) -> Column:
    idx = F.col(index_col) if isinstance(index_col, str) else index_col
    return F.element_at(F.array(*[F.lit(c) for c in classes]), idx.cast("int") + 1)


class MajorityModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, DefaultParamsReadable,
                    DefaultParamsWritable):
    majority = Param(Params._dummy(), "majority", "predicted class index", TypeConverters.toFloat)
    numClasses = Param(Params._dummy(), "numClasses", "number of classes", TypeConverters.toInt)

    @keyword_only
    def __init__(self, majority=0.0, numClasses=1, predictionCol="prediction", probabilityCol="probability",
                 featuresCol="features"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        k, m = self.getOrDefault(self.numClasses), int(self.getOrDefault(self.majority))
        onehot = array_to_vector(F.array(*[F.lit(1.0 if i == m else 0.0) for i in range(k)]))
        return df.withColumns({self.getPredictionCol(): F.lit(float(m)), self.getProbabilityCol(): onehot})


class MajorityClassifier(Estimator, HasLabelCol, HasFeaturesCol, HasPredictionCol, HasProbabilityCol,
                         DefaultParamsReadable, DefaultParamsWritable):
    """Always predicts the most frequent training class (ties -> lowest
    index); probability is one-hot. Fit is a two-level count aggregate."""

    numClasses = Param(Params._dummy(), "numClasses", "number of classes", TypeConverters.toInt)

    @keyword_only
    def __init__(self, labelCol="label", featuresCol="features", predictionCol="prediction",
                 probabilityCol="probability", numClasses=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> MajorityModel:
        from strata.operators.describe import modes
        label = self.getLabelCol()
        mode = modes(df, [label])[label]
        k = self.getOrDefault(self.numClasses) if self.isDefined(self.numClasses) else int(
            df.agg(F.max(label)).first()[0]) + 1
        return MajorityModel(majority=float(mode), numClasses=k, predictionCol=self.getPredictionCol(),
                             probabilityCol=self.getProbabilityCol(), featuresCol=self.getFeaturesCol())


def logistic_regression(n_weighted: float, c: float = 1.0, max_iter: int = 2000, tol: float = 1e-4,
                        **kw) -> LogisticRegression:
    """Multinomial L2 logistic regression. An objective ``0.5|w|^2 +
    C * sum(w_i loss_i)`` equals Spark's mean-loss form with
    ``regParam = 1 / (C * sum(w_i))``; features are pre-standardized."""
    return LogisticRegression(featuresCol="features", labelCol="label_idx", weightCol="weight",
                              family="multinomial", elasticNetParam=0.0, regParam=1.0 / (c * n_weighted),
                              maxIter=max_iter, standardization=False, tol=tol, **kw)


def random_forest(num_trees: int = 500, min_leaf: int = 2, max_depth: int | None = None,
                  feature_subset: str = "sqrt", bootstrap: bool = True, seed: int = RANDOM_STATE,
                  **kw) -> ForestClassifier:
    if max_depth is not None and max_depth > MAX_TREE_DEPTH:
        raise ValueError(f"trees of more than {MAX_TREE_DEPTH} levels are not supported")
    depth = MAX_TREE_DEPTH if max_depth is None else int(max_depth)
    # where Spark ML's own forest is fitted: a row's node is kept for each tree, instead of sending the growing trees
    # to every task and walking them again. The kept nodes are checkpointed, which cuts their lineage
    checkpoint_dir(SparkSession.active())
    return ForestClassifier(featuresCol="features", labelCol="label_idx", weightCol="weight",
                            numTrees=num_trees, minInstancesPerNode=min_leaf, maxDepth=depth,
                            featureSubsetStrategy=feature_subset, bootstrap=bootstrap, seed=seed,
                            maxBins=64, cacheNodeIds=True, **kw)


ModelBuilder = Callable[..., Pipeline]


def build_pipeline(classifier, numeric: Sequence[str], categorical: Sequence[str]) -> Pipeline:
    return Pipeline(stages=[*preprocessing_stages(numeric, categorical), classifier])


def candidate_models(numeric: Sequence[str], categorical: Sequence[str], n_weighted: float, num_classes: int,
                     num_trees: int = 500) -> dict[str, Pipeline]:
    """The three candidates compared by cross-validation."""
    return {
        "random_forest": build_pipeline(random_forest(num_trees=num_trees), numeric, categorical),
        "logistic_regression": build_pipeline(logistic_regression(n_weighted), numeric, categorical),
        "majority_class": build_pipeline(MajorityClassifier(labelCol="label_idx", numClasses=num_classes),
                                         numeric, categorical),
    }


# Hyper-parameter search spaces (compact grid and wide
# random space), with the original project's values. Spark names: numTrees
# (n_estimators), maxDepth (max_depth; None -> 30, Spark's cap),
# minInstancesPerNode (min_samples_leaf), featureSubsetStrategy
# (max_features; None -> "all"), balanced (class_weight: balanced or
# balanced_subsample -> balanced weights, None -> unit weights).
# min_samples_split and the liblinear solver have no Spark counterpart and
# are not searched.
PARAMETER_GRID = {
    "logistic_regression": {"C": [0.01, 0.1, 1.0, 10.0]},
    "random_forest": {
        "numTrees": [300, 500],
        "maxDepth": [None, 6, 10],
        "minInstancesPerNode": [1, 2, 4],
        "featureSubsetStrategy": ["sqrt", "0.5"],
    },
}
PARAMETER_DISTRIBUTIONS = {
    "logistic_regression": {
        "C": [0.001, 0.01, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 50.0, 100.0],
        "balanced": [False, True],
    },
    "random_forest": {
        "numTrees": [100, 200, 300, 500, 750],
        "maxDepth": [None, 5, 10, 15, 20, 30],
        "minInstancesPerNode": [1, 2, 4, 8],
        "featureSubsetStrategy": ["sqrt", "log2", "all"],
        "balanced": [False, True, True],
        "bootstrap": [True, False],
    },
}


def configure(name: str, params: dict, numeric: Sequence[str], categorical: Sequence[str], n_weighted: float,
              num_classes: int) -> Pipeline:
    """Pipeline for candidate ``name`` with sampled ``params`` applied;
    ``balanced=False`` drops the class weights."""
    if name == "random_forest":
        clf = random_forest(num_trees=params.get("numTrees", 500), min_leaf=params.get("minInstancesPerNode", 2),
                            max_depth=params.get("maxDepth"),
                            feature_subset=params.get("featureSubsetStrategy", "sqrt"),
                            bootstrap=params.get("bootstrap", True))
    elif name == "logistic_regression":
        clf = logistic_regression(n_weighted, c=params.get("C", 1.0))
    elif name == "majority_class":
        clf = MajorityClassifier(labelCol="label_idx", numClasses=num_classes)
    else:
        raise ValueError(f"unknown model {name!r}")
    if not params.get("balanced", True) and clf.hasParam("weightCol"):
        clf.clear(clf.weightCol)
    return build_pipeline(clf, numeric, categorical)


def params_json(params: dict) -> str:
    return json.dumps(params, sort_keys=True)
