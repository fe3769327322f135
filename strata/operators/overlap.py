"""Overlap audit between an external dataset and the training data.

Keys are compared by digest: one pass over the training rows gives the digests
of both key kinds, counted per digest, and external rows meet the same counted
table once per kind. Shuffles carry 32-byte SHA-256 digests (of the kind and
the key, so that the kinds share a table; no two texts with one such digest are
known), never a key text as their key, and the audit never multiplies rows.
Rows with an empty key cannot match; their join key is replaced by a per-row
unique value so they spread evenly over shuffle partitions instead of piling
into one. Hot non-empty keys are left to AQE skew-join splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.text import code_key, name_key
from strata.session import cut_lineage

RULES = ("either", "both", "name", "ticket")
# Names of the audit's columns.
AUDIT_COLUMNS = ("NormalizedName", "NormalizedTicket", "NameMatch", "TicketMatch", "NameAndTicketMatch",
                 "NameOrTicketMatch", "NameMatchCount", "TicketMatchCount", "OverlapEvidence")


def training_match_keys(training: DataFrame, name_col: str, ticket_col: str, id_col: str | None = None) -> DataFrame:
    """(TrainingId, NormalizedName, NormalizedTicket) per training row; the
    id is the given column or a file-order row number."""
    if id_col is None:
        from strata.operators.rows import with_row_number
        training = with_row_number(training, "_training_row")
        id_col = "_training_row"
    return training.select(F.col(id_col).alias("TrainingId"), name_key(name_col).alias("NormalizedName"),
                           code_key(ticket_col).alias("NormalizedTicket"))


def _digest(kind: str, key: Column) -> Column:
    """Digest of a non-empty key; null for an empty or null one. The key must be a
    column of its own already: the accent UDF inside is not to be run twice."""
    return F.when(key != "", F.unhex(F.sha2(F.concat(F.lit(kind + ":"), key).cast("binary"), 256)))


def _digested(keys: DataFrame, key: str) -> DataFrame:
    """(_digest, key, TrainingId) of the rows with a non-empty key."""
    return keys.select(_digest(key, F.col(key)).alias("_digest"), key, "TrainingId").filter("_digest IS NOT NULL")


def _counted(digests: DataFrame) -> DataFrame:
    return digests.groupBy("_digest").agg(F.count(F.lit(1)).alias("match_count"))


def match_lookup(keys: DataFrame, key: str) -> DataFrame:
    """All training ids per non-empty key in long form: (key, TrainingId,
    match_count). Linear in the training rows and exact; a hot key is just
    many rows (spread by AQE skew handling), never one collected group."""
    valid = _digested(keys, key)
    return valid.join(_counted(valid), "_digest").drop("_digest")


def _lists(rows: DataFrame, *more: str) -> DataFrame:
    key = next(c for c in rows.columns if c not in ("_digest", "TrainingId", "match_count", "chunk"))
    return rows.groupBy("_digest", *more).agg(
        F.first(key).alias(key), F.count(F.lit(1)).alias("_n"), F.array_sort(F.collect_list("TrainingId")).alias("matched_ids"))


def _id_lists(keys: DataFrame, key: str, ids_per_row: int) -> DataFrame:
    valid = _digested(keys, key)
    counts = _counted(valid)
    columns = ("_digest", key, "match_count", "chunk", "matched_ids")
    long = counts.filter(F.col("match_count") > ids_per_row)
    if long.isEmpty():
        return _lists(valid).withColumns({"match_count": F.col("_n"), "chunk": F.lit(0).cast("long")}).select(*columns)
    short = valid.join(counts.filter(F.col("match_count") <= ids_per_row), "_digest", "left_semi")
    short = _lists(short).withColumns({"match_count": F.col("_n"), "chunk": F.lit(0).cast("long")})
    # A long key's rows lie in order over as many partitions as they need; an id's
    # place is its place in the partition and the key's rows in the partitions before.
    ranged = valid.join(long, "_digest").repartitionByRange("_digest", "TrainingId")
    ranged = cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy("_digest").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_digest", "_part").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.select("_digest", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("_digest", "_part").orderBy("TrainingId")
    place = F.col("_before") + F.row_number().over(own) - 1
    ranked = ranged.join(parts, ["_digest", "_part"]).withColumn("chunk", F.floor(place / ids_per_row).cast("long"))
    chunks = _lists(ranked.select("_digest", key, "TrainingId", "match_count", "chunk"), "match_count", "chunk")
    return short.select(*columns).unionByName(chunks.select(*columns))


def match_id_lists(keys: DataFrame, key: str, ids_per_row: int = 10_000) -> DataFrame:
    """(key, match_count, chunk, matched_ids): the sorted ids of every non-empty key.

    A row holds at most ``ids_per_row`` ids; a key with more of them has further
    rows, ``chunk`` 0, 1, 2 and so on, whose ids ascend from one to the next. No
    task gathers a key's ids beyond that number."""
    return _id_lists(keys, key, ids_per_row).drop("_digest")


def _spread_empty(digest: Column, row_id: Column) -> Column:
    """A digest, or where there is none a value that no digest takes, unique per
    row (the row id, or a generated per-row number when the id is null)."""
    unique = F.coalesce(row_id.cast("string"), F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string")))
    return F.coalesce(digest, F.concat(F.lit("\u0000"), unique).cast("binary"))


def audit_overlap(
    external: DataFrame,
    training: DataFrame,
    *,
    name_col: str = "Name",
    ticket_col: str = "Ticket",
    external_id: str = "PassengerId",
    training_id: str | None = "PassengerId",
    with_ids: bool = False,
    max_ids_per_key: int = 10_000,
) -> DataFrame:
    """External rows + normalized keys, match flags, match counts, evidence
    (``name_and_ticket`` > ``name_only`` > ``ticket_only`` > ``none``) and,
    with ``with_ids``, the sorted matching training ids per key. A key with
    more than ``max_ids_per_key`` ids has null for its list beside its count:
    ``match_id_lists`` has them all, in rows of bounded size."""
    keys = training_match_keys(training, name_col, ticket_col,
                               training_id if training_id in training.columns else None)
    audit = external.withColumns({"NormalizedName": name_key(name_col), "NormalizedTicket": code_key(ticket_col)})
    kinds = {"Name": "NormalizedName", "Ticket": "NormalizedTicket"}
    audit = audit.select("*", *[
        _spread_empty(_digest(c, F.col(c)), F.col(external_id)).alias(f"_d{kind}") for kind, c in kinds.items()])
    # one scan of the training rows for both kinds: both joins read the same counted exchange
    digests = keys.select(F.explode(F.array(*[_digest(c, F.col(c)) for c in kinds.values()])).alias("_digest"))
    counts = _counted(digests.filter("_digest IS NOT NULL"))
    for kind, c in kinds.items():
        own = counts.select(F.col("_digest").alias(f"_k{kind}"), F.col("match_count").alias(f"{kind}MatchCount"))
        audit = audit.join(own, F.col(f"_d{kind}") == F.col(f"_k{kind}"), "left").drop(f"_k{kind}")
        if with_ids:
            lists = _id_lists(keys, c, max_ids_per_key).filter(F.col("match_count") <= max_ids_per_key)
            lists = lists.select(F.col("_digest").alias(f"_k{kind}"), F.col("matched_ids").alias(f"MatchedTrainingIdsBy{kind}"))
            audit = audit.join(lists, F.col(f"_d{kind}") == F.col(f"_k{kind}"), "left").drop(f"_k{kind}")
    audit = audit.drop(*[f"_d{kind}" for kind in kinds])
    name_m = F.col("NameMatchCount").isNotNull()
    ticket_m = F.col("TicketMatchCount").isNotNull()
    audit = audit.withColumns({
        "NameMatch": name_m, "TicketMatch": ticket_m,
        "NameAndTicketMatch": name_m & ticket_m, "NameOrTicketMatch": name_m | ticket_m,
        "NameMatchCount": F.coalesce("NameMatchCount", F.lit(0)).cast("long"),
        "TicketMatchCount": F.coalesce("TicketMatchCount", F.lit(0)).cast("long"),
        "OverlapEvidence": F.when(name_m & ticket_m, "name_and_ticket").when(name_m, "name_only")
        .when(ticket_m, "ticket_only").otherwise("none"),
    })
    if with_ids:
        none = F.array().cast(keys.schema["TrainingId"].dataType.simpleString().join(("array<", ">")))
        audit = audit.withColumns({
            f"MatchedTrainingIdsBy{kind}": F.when(F.col(f"{kind}MatchCount") == 0, none).otherwise(F.col(f"MatchedTrainingIdsBy{kind}"))
            for kind in kinds})
    return audit


def overlap_mask(rule: str) -> Column:
    """Which audited rows count as overlapping under ``rule``."""
    columns = {"either": "NameOrTicketMatch", "both": "NameAndTicketMatch", "name": "NameMatch",
               "ticket": "TicketMatch"}
    if rule not in columns:
        raise ValueError(f"Unsupported overlap rule: {rule}")
    return F.col(columns[rule])


def nonoverlap(audit: DataFrame, rule: str = "either", extra_audit_columns: Sequence[str] = (
        "MatchedTrainingIdsByName", "MatchedTrainingIdsByTicket")) -> DataFrame:
    """Audited rows not overlapping under ``rule``, audit columns dropped."""
    drop = [c for c in (*AUDIT_COLUMNS, *extra_audit_columns) if c in audit.columns]
    return audit.filter(~overlap_mask(rule)).drop(*drop)


def overlap_summary(audit: DataFrame, training_rows: Column | int, rule: str = "either",
                    decimals: int = 2) -> DataFrame:
    """One row: external/training rows, name/ticket/both/either matches,
    rows kept under ``rule`` and their percentage; one aggregate."""
    keep = ~overlap_mask(rule)
    return audit.agg(
        F.count(F.lit(1)).alias("external_rows"),
        F.lit(training_rows).cast("long").alias("training_rows"),
        F.sum(F.col("NameMatch").cast("int")).cast("long").alias("name_matches"),
        F.sum(F.col("TicketMatch").cast("int")).cast("long").alias("ticket_matches"),
        F.sum(F.col("NameAndTicketMatch").cast("int")).cast("long").alias("both_matches"),
        F.sum(F.col("NameOrTicketMatch").cast("int")).cast("long").alias("either_matches"),
        F.sum(keep.cast("int")).cast("long").alias("nonoverlap_rows"),
        F.round(F.lit(100.0) * F.avg(keep.cast("double")), decimals).alias("nonoverlap_percent"),
    )


def class_counts_before_after(audit: DataFrame, rule: str = "either", class_col: str = "Pclass") -> DataFrame:
    """Rows per class before and after removing overlaps."""
    keep = ~overlap_mask(rule)
    return audit.groupBy(class_col).agg(F.count(F.lit(1)).alias("rows_before"),
                                        F.sum(keep.cast("int")).cast("long").alias("rows_after"))
