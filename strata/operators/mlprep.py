"""Feature preparation stages for Spark ML pipelines.

Spark's ``Imputer(strategy="median")`` uses approximate quantiles and
``StandardScaler`` divides by the sample std; the reference semantics need
the exact median and the population std, so these two (and mode
imputation) are small Estimators whose ``fit`` is one Spark aggregate.
All stages are persistable inside a ``PipelineModel``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _JsonValues(Params):
    values = Param(Params._dummy(), "values", "fitted values per column, JSON", TypeConverters.toString)

    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.values))


class FillValuesModel(Model, HasInputCols, _JsonValues, DefaultParamsReadable, DefaultParamsWritable):
    """Replace nulls (and NaN) of each input column with its fitted value."""

    @keyword_only
    def __init__(self, inputCols=None, values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fills = self.fitted()
        cols = {}
        for c, v in fills.items():
            col = F.col(c)
            missing = col.isNull()
            if dict(df.dtypes)[c] in ("double", "float"):
                missing = missing | F.isnan(col)
            cols[c] = F.when(missing, F.lit(v)).otherwise(col)
        return df.withColumns(cols)


class MedianImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Exact median per column (one distributed sort for all columns);
    ``relativeError`` > 0 switches to ``percentile_approx``.
    A column with no values is filled with null (left as is)."""

    relativeError = Param(Params._dummy(), "relativeError", "0 = exact median", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCols=None, relativeError=0.0):
        super().__init__()
        self._setDefault(relativeError=0.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> FillValuesModel:
        from strata.operators.quantiles import medians_by_column
        cols = self.getInputCols()
        err = self.getOrDefault(self.relativeError)
        meds = medians_by_column(df, cols, accuracy=int(1 / err) if err > 0 else None)
        return FillValuesModel(inputCols=cols, values=json.dumps({c: meds.get(c) for c in cols}))


class ModeImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Most frequent value per column, ties -> smallest value."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> FillValuesModel:
        from strata.operators.describe import modes
        cols = self.getInputCols()
        found = modes(df, cols)
        return FillValuesModel(inputCols=cols, values=json.dumps({c: found.get(c) for c in cols}))


class PopulationScalerModel(Model, HasInputCols, _JsonValues, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        stats = self.fitted()
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()})


class PopulationScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Standardize in place with the mean and the population std; a column
    with zero (or undefined) std is only centered."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        cols = self.getInputCols()
        aggs = []
        for c in cols:
            aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
        row = df.agg(*aggs).first()
        stats = {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] if row[f"s_{c}"] else 1.0) for c in cols}
        return PopulationScalerModel(inputCols=cols, values=json.dumps(stats))


def preprocessing_stages(numeric: Sequence[str], categorical: Sequence[str], features_col: str = "features",
                         median_relative_error: float = 0.0) -> list:
    """median-impute + standardize numerics; mode-impute + one-hot
    categoricals (alphabetical categories, unseen -> all zeros); assemble.
    Columns not listed are ignored by the model."""
    numeric, categorical = list(numeric), list(categorical)
    stages: list = []
    if numeric:
        stages += [MedianImputer(inputCols=numeric, relativeError=median_relative_error),
                   PopulationScaler(inputCols=numeric)]
    onehots = []
    if categorical:
        stages.append(ModeImputer(inputCols=categorical))
        idx = [f"{c}__idx" for c in categorical]
        onehots = [f"{c}__onehot" for c in categorical]
        stages.append(StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        # the indexer metadata ends with its "unknown" label; dropLast removes
        # exactly that slot, so unseen categories encode as all zeros
        stages.append(OneHotEncoder(inputCols=idx, outputCols=onehots, dropLast=True, handleInvalid="error"))
    stages.append(VectorAssembler(inputCols=numeric + onehots, outputCol=features_col, handleInvalid="keep"))
    return stages
