"""Model explanation: built-in importances per encoded feature, summed per
source column, and permutation importance computed as one batched Spark
job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.evaluate import confusion_counts, metrics_from_confusion
from strata.operators.mlprep import FillValuesModel, PopulationScalerModel
from strata.operators.split import hash_rank, seeded_hash
from strata.session import cut_lineage


def encoded_feature_names(model: PipelineModel, transformed: DataFrame, features_col: str = "features") -> list[str]:
    """Names of the assembled vector slots from the column metadata
    (one-hot slots read ``<column>__onehot_<category>``)."""
    attrs = transformed.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = []
    for group in attrs.values():
        slots.extend(group)
    names = [None] * len(slots)
    for a in slots:
        names[a["idx"]] = a["name"]
    return names


def model_importance(model: PipelineModel, transformed: DataFrame, features_col: str = "features") -> DataFrame:
    """(feature, importance) per encoded slot, sorted descending: impurity
    importance for forests, mean |coefficient| over classes for linear
    models, zeros for the majority baseline."""
    names = encoded_feature_names(model, transformed, features_col)
    clf = model.stages[-1]
    if hasattr(clf, "featureImportances"):
        values = clf.featureImportances.toArray().tolist()
    elif hasattr(clf, "coefficientMatrix"):
        m = clf.coefficientMatrix.toArray()
        values = abs(m).mean(axis=0).tolist()
    else:
        values = [0.0] * len(names)
    spark = transformed.sparkSession
    df = spark.createDataFrame(list(zip(names, [float(v) for v in values])), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature")


def source_of(feature: str, sources: Sequence[str]) -> str:
    """Longest source column equal to, or a ``_``-separated prefix of, the
    encoded name; unmatched names map to themselves."""
    best = None
    for s in sources:
        if feature == s or feature.startswith(s + "_"):
            if best is None or len(s) > len(best):
                best = s
    return best or feature


def aggregate_importance(importance: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Importance summed per source column (encoded -> source map joined
    as a small parameter table), sorted descending."""
    names = [r.feature for r in importance.select("feature").collect()]  # one row per model slot
    spark = importance.sparkSession
    mapping = spark.createDataFrame([(n, source_of(n, sources)) for n in names], "feature string, source string")
    joined = importance.join(F.broadcast(mapping), "feature")
    return joined.groupBy("source").agg(F.sum("importance").alias("importance")).orderBy(
        F.col("importance").desc(), "source")


def feature_slots(model: PipelineModel, prepared: DataFrame, features: Sequence[str]) -> dict[str, tuple[int, int]] | None:
    """Slots (from, to) of the assembled vector that each raw column fills, for a
    pipeline whose preparation takes every column by itself and keeps every row;
    None for any other. ``prepared`` has gone through all stages but the last."""
    stages = getattr(model, "stages", None) or [None]
    *steps, assembler = stages[:-1] or [None]
    if not isinstance(assembler, VectorAssembler) or assembler.getHandleInvalid() == "skip":
        return None
    if assembler.getOutputCol() != stages[-1].getOrDefault("featuresCol"):
        return None
    origin = {c: c for c in features}
    for stage in steps:
        if isinstance(stage, (FillValuesModel, PopulationScalerModel)):
            continue  # in place
        if not isinstance(stage, (StringIndexerModel, OneHotEncoderModel)) or stage.getHandleInvalid() == "skip":
            return None
        several = stage.isSet("inputCols")
        names = zip(stage.getInputCols(), stage.getOutputCols()) if several else [(stage.getInputCol(), stage.getOutputCol())]
        for source, out in names:
            if out in origin:
                return None
            origin[out] = origin.get(source, source)
    slots, at = {}, 0
    for c in assembler.getInputCols():
        field = prepared.schema[c]
        width = field.metadata.get("ml_attr", {}).get("num_attrs") if field.dataType.typeName() == "vectorudt" else 1
        source = origin.get(c, c)
        if width is None or source in slots:
            return None
        slots[source] = (at, at + width)
        at += width
    return {f: slots.get(f, (0, 0)) for f in features}


def permutation_importance(
    model: PipelineModel,
    data: DataFrame,
    features: Sequence[str],
    *,
    label_col: str = "label_idx",
    id_col: str = "row_id",
    repeats: int = 20,
    seed: int = 42,
) -> DataFrame:
    """Drop in macro F1 when one raw feature column is shuffled, mean and
    population std over ``repeats`` shuffles, sorted descending.

    A shuffle gives every row the values of another, its donor: rows have one
    place for all repeats (a rank of their ids by a seeded hash), and a rank per
    repeat says whose values stand there. Only ids are ranked; each repeat's
    donor values then meet the row by id. Rows are copied per feature on the
    way into the model alone, after the last shuffle, and only counts leave it:
    metrics of all copies come from one grouped confusion table. Ids must be
    unique and not null.

    Where the pipeline prepares every column by itself (``feature_slots``), rows
    are prepared once, and a copy takes the donor's slots of the prepared
    vector; only the classifier runs on the copies. Elsewhere a copy takes the
    donor's raw value through the whole pipeline.
    """
    slots, prepared = None, data
    if isinstance(model, PipelineModel):
        prepared = PipelineModel(model.stages[:-1]).transform(data)
        slots = feature_slots(model, prepared, features)
    row_id, label = F.col(id_col).alias("_own"), F.col(label_col).alias("_label")
    if slots is None:
        raw = F.struct(*[F.col(f"`{f}`") for f in features])
        rows, predict = data.select("*", row_id, label, raw.alias("_values")), model.transform
        base_pred = predict(data).select(F.col(label_col).alias("_label"), "prediction")
    else:
        classifier, vector = model.stages[-1], model.stages[-1].getOrDefault("featuresCol")
        rows = cut_lineage(prepared.select(row_id, label, vector_to_array(vector).alias("_values")))
        predict = lambda df: classifier.transform(df.withColumn(vector, array_to_vector("_values")))
        base_pred = predict(rows)
    base = metrics_from_confusion(confusion_counts(base_pred, "_label", "prediction")).first()["f1_macro"]
    ids = rows.select(F.col("_own").alias("_id"), F.lit(-1).alias("_repeat"))
    again = ids.select("_id", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_repeat"))
    order = seeded_hash(seed, "_repeat", "_id")
    place = hash_rank(ids, "_repeat", order, ["_id"], "_place").drop("_repeat")
    donor = hash_rank(again, "_repeat", order, ["_id"], "_place").withColumnRenamed("_id", "_donor")
    values = rows.select(F.col("_own").alias("_donor"), F.col("_values").alias("_given"))
    given = place.join(donor, "_place").join(values, "_donor").select("_id", "_repeat", "_given")
    # a row becomes as many copies as there are features: spread over all cores, however few bytes they are
    spark = data.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    met = rows.join(given.repartition(tasks, "_id"), F.col("_own") == F.col("_id"))
    if slots is None:
        copies = met.select("*", F.explode(F.array(*[F.lit(f) for f in features])).alias("_feature"))
        copies = copies.withColumns({
            f: F.when(F.col("_feature") == f, F.col("_given")[f]).otherwise(F.col(f"`{f}`")) for f in features})
        copies = copies.drop("_values", "_given", "_id", "_own")
    else:
        which = F.inline(F.array(*[F.struct(F.lit(f).alias("_feature"), F.lit(a).alias("_from"), F.lit(b).alias("_to"))
                                   for f, (a, b) in slots.items()]))
        mixed = F.expr("concat(slice(_values, 1, _from), slice(_given, _from + 1, _to - _from),"
                       " slice(_values, _to + 1, size(_values) - _to))")
        copies = met.select("_label", "_repeat", "_values", "_given", which)
        copies = copies.select("_label", "_repeat", "_feature", mixed.alias("_values"))
    groups = ["_feature", "_repeat"]
    scores = metrics_from_confusion(confusion_counts(predict(copies), "_label", "prediction", group=groups), group=groups)
    return (scores.groupBy(F.col("_feature").alias("feature"))
            .agg(F.avg(F.lit(base) - F.col("f1_macro")).alias("importance_mean"),
                 F.stddev_pop(F.lit(base) - F.col("f1_macro")).alias("importance_std"))
            .orderBy(F.col("importance_mean").desc(), "feature"))
