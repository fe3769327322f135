"""Harmonize an external source to the canonical schema.

A declarative ``select``: class filter + recode, yes/no survival code,
whitespace/blank normalization, lenient numbers, strict integers, port
codes, synthetic file-order ids; then one domain-check aggregate and a
filter summary. The source is never collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators import quality as Q
from strata.operators.rows import with_row_number

# The external source's required columns.
EXTERNAL_REQUIRED = ("name", "gender", "age", "class", "embarked", "ticketno", "fare", "sibsp", "parch", "survived")
CANONICAL_SEXES = ("female", "male")


@dataclass(frozen=True)
class ExternalSpec:
    """Column names of the external source and the class mapping."""

    class_codes: Mapping[str, int] = field(default_factory=lambda: dict(X.EXTERNAL_CLASS_CODES))
    required: Sequence[str] = EXTERNAL_REQUIRED
    optional: Sequence[str] = ("country",)
    sexes: Sequence[str] = CANONICAL_SEXES


def harmonize_external(df: DataFrame, spec: ExternalSpec = ExternalSpec(), *, check_domain: bool = True) -> DataFrame:
    """External rows whose normalized class is mapped, in canonical form:
    PassengerId, Survived, Pclass, Name, Sex, Age, SibSp, Parch, Ticket,
    Fare, Cabin, Embarked, Country, ExternalSourceRow."""
    Q.require_columns(df, spec.required, "external data")
    cls = X.lower_trim("class")
    kept = df.filter(cls.isin(list(spec.class_codes)))
    if check_domain:
        # strict integers and domain rules, counted in one pass over the source
        sex = X.lower_trim("gender")
        Q.check_rules(kept, [
            *Q.integer_rules(["sibsp", "parch"]),
            ("External data contains missing sex values", sex.isNull(), F.col("gender")),
            ("Unexpected values in external gender column", sex.isNotNull() & ~sex.isin(list(spec.sexes)), sex),
        ])
    else:
        Q.check_rules(kept, Q.integer_rules(["sibsp", "parch"]))
    kept = with_row_number(kept, "_row")
    ints = {c: Q._integer_checks(c)[0].cast("long") for c in ("sibsp", "parch")}
    clean = kept.select(
        F.col("_row").alias("PassengerId"),
        X.yes_no_code("survived").alias("Survived"),
        X.recode(X.lower_trim("class"), spec.class_codes).cast("long").alias("Pclass"),
        X.normalize_whitespace("name").alias("Name"),
        X.lower_trim("gender").alias("Sex"),
        X.to_double(F.col("age").cast("string")).alias("Age"),
        ints["sibsp"].alias("SibSp"),
        ints["parch"].alias("Parch"),
        X.blank_to_null("ticketno").alias("Ticket"),
        X.to_double(F.col("fare").cast("string")).alias("Fare"),
        F.lit(None).cast("string").alias("Cabin"),
        X.port_code("embarked").alias("Embarked"),
        (X.blank_to_null("country") if "country" in df.columns else F.lit(None).cast("string")).alias("Country"),
        F.col("_row").alias("ExternalSourceRow"),
    )
    # Pclass cannot be null (rows were kept only for mapped classes) and
    # Name cannot be null (whitespace normalization maps null to '')
    return clean


def class_filter_summary(df: DataFrame, spec: ExternalSpec = ExternalSpec()) -> DataFrame:
    """Long table (metric, key, value): source rows, retained/excluded
    rows, retained rows per class code, excluded rows per normalized class
    (null -> ``missing``). One aggregation over the source."""
    cls = X.lower_trim("class")
    code = X.recode(cls, spec.class_codes)
    per = df.groupBy(F.coalesce(cls, F.lit("missing")).alias("cls"), code.alias("code")).agg(
        F.count(F.lit(1)).alias("n"))
    totals = per.agg(
        F.sum("n").alias("source_rows"),
        F.sum(F.when(F.col("code").isNotNull(), F.col("n")).otherwise(0)).alias("retained_rows"),
        F.sum(F.when(F.col("code").isNull(), F.col("n")).otherwise(0)).alias("excluded_rows"))
    total_rows = totals.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit("").alias("key"), F.col(m).cast("long").alias("value"))
        for m in ("source_rows", "retained_rows", "excluded_rows")])))
    retained = per.filter(F.col("code").isNotNull()).groupBy("code").agg(F.sum("n").cast("long").alias("value")).select(
        F.lit("retained_class_rows").alias("metric"), F.col("code").cast("string").alias("key"), "value")
    excluded = per.filter(F.col("code").isNull()).select(
        F.lit("excluded_class_rows").alias("metric"), F.col("cls").alias("key"), F.col("n").cast("long").alias("value"))
    return total_rows.unionByName(retained).unionByName(excluded)
