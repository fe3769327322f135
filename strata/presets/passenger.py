"""Passenger preset: the canonical schema, feature preparation, the four
views and the twenty named analyses, all as DataFrame builders over a
prepared ``passengers`` DataFrame.

The output column names and query names below are fixed values that
downstream consumers depend on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators import cohort as C
from strata.operators import quality as Q
from strata.sources.catalog import NamedQuery

# Canonical schema.
ID = "PassengerId"
TARGET = "Pclass"
RAW_INTEGERS = ("PassengerId", "Survived", "Pclass", "SibSp", "Parch")
RAW_DOUBLES = ("Age", "Fare")
RAW_STRINGS = ("Name", "Sex", "Ticket", "Cabin", "Embarked")
TRAINING_REQUIRED = RAW_INTEGERS + RAW_DOUBLES + RAW_STRINGS
SCORING_REQUIRED = ("PassengerId", "Name", "Sex", "Age", "SibSp", "Parch", "Ticket", "Fare", "Cabin", "Embarked")
FEATURE_REQUIRED = ("Name", "Age", "SibSp", "Parch", "Ticket", "Fare", "Cabin")
DERIVED = ("Title", "Surname", "FamilySize", "IsAlone", "FamilySizeGroup", "HasCabin", "CabinDeck", "CabinCount",
           "TicketPrefix", "AgeGroup", "FareLog")
NUMERIC_FEATURES = ("Age", "SibSp", "Parch", "Fare", "FamilySize", "IsAlone", "HasCabin", "CabinCount", "FareLog")
CATEGORICAL_FEATURES = ("Sex", "Embarked", "Title", "FamilySizeGroup", "CabinDeck", "TicketPrefix")
EXPECTED_VALUES = {"Pclass": (1, 2, 3), "Survived": (0, 1), "Sex": ("female", "male"), "Embarked": ("C", "Q", "S")}
FAMILY_GROUP_ORDER = ("Alone", "Small", "Medium", "Large")


def range_rules() -> dict:
    """The invalid-value rules of the quality report."""
    return {
        "negative_age_rows": F.col("Age") < 0,
        "age_above_100_rows": F.col("Age") > 100,
        "negative_fare_rows": F.col("Fare") < 0,
        "negative_sibsp_rows": F.col("SibSp") < 0,
        "negative_parch_rows": F.col("Parch") < 0,
    }


def quality_report(df: DataFrame) -> DataFrame:
    """Data-quality report of a (standardized) passenger table: shape,
    missing values, duplicates, types, unexpected categories and the
    invalid-value counts above."""
    return Q.quality_report(df, id_column=ID, expected=EXPECTED_VALUES, ranges=range_rules())


def add_passenger_features(df: DataFrame) -> DataFrame:
    """The 11 derived columns (one ``withColumns``; input untouched)."""
    Q.require_columns(df, FEATURE_REQUIRED, "feature input")
    fs = X.family_size("SibSp", "Parch")
    return df.withColumns({
        "Title": X.extract_title("Name"),
        "Surname": X.extract_surname("Name"),
        "FamilySize": fs,
        "IsAlone": (fs == 1).cast("int"),
        "FamilySizeGroup": X.bin_column(fs, X.FAMILY_SIZE_EDGES, X.FAMILY_SIZE_LABELS),
        "HasCabin": X.presence_flag("Cabin"),
        "CabinDeck": X.first_letter("Cabin"),
        "CabinCount": X.token_count("Cabin"),
        "TicketPrefix": X.token_prefix("Ticket"),
        "AgeGroup": X.bin_column("Age", X.AGE_GROUP_EDGES, X.AGE_GROUP_LABELS, include_lowest=True),
        "FareLog": X.log1p("Fare"),
    })


def standardize(df: DataFrame, strict: bool = True) -> DataFrame:
    return Q.standardize_types(df, integers=RAW_INTEGERS, doubles=RAW_DOUBLES, strings=RAW_STRINGS,
                               strict=strict)


def prepare_passenger_data(df: DataFrame, *, required=TRAINING_REQUIRED, strict: bool = True) -> DataFrame:
    """Required-column check -> type standardization -> features. No
    imputation and nothing fitted."""
    Q.require_columns(df, required, "passenger data")
    return add_passenger_features(standardize(df, strict))


# ---------------------------------------------------------------------------
# Views
# ---------------------------------------------------------------------------

def class_profile(p: DataFrame) -> DataFrame:
    return C.group_profile(p, F.col("Pclass").alias("passenger_class"), {
        "average_age": X.rounded_avg("Age"), "average_fare": X.rounded_avg("Fare"),
        "average_family_size": X.rounded_avg("FamilySize"),
        "percent_travelling_alone": X.rate_pct("IsAlone"), "percent_with_cabin": X.rate_pct("HasCabin")},
        count_name="passenger_count")


def embarkation_class_mix(p: DataFrame) -> DataFrame:
    return C.share_within(p, F.col("Embarked").alias("embarkation_port"), F.col("Pclass").alias("passenger_class"),
                          count_name="passenger_count", share_name="percentage_within_port")


def family_profile(p: DataFrame) -> DataFrame:
    return C.group_profile(p, [F.col("FamilySizeGroup").alias("family_size_group"),
                               F.col("Pclass").alias("passenger_class")],
                           {"average_fare": X.rounded_avg("Fare")}, count_name="passenger_count")


def cabin_profile(p: DataFrame) -> DataFrame:
    return C.group_profile(p, [F.col("CabinDeck").alias("cabin_deck"), F.col("Pclass").alias("passenger_class")], {},
                           count_name="passenger_count")


VIEWS = {"vw_class_profile": class_profile, "vw_embarkation_class_mix": embarkation_class_mix,
         "vw_family_profile": family_profile, "vw_cabin_profile": cabin_profile}


def register_views(spark: SparkSession, passengers: DataFrame, table: str = "passengers") -> None:
    passengers.createOrReplaceTempView(table)
    for name, build in VIEWS.items():
        build(passengers).createOrReplaceTempView(name)


# ---------------------------------------------------------------------------
# The twenty analyses
# ---------------------------------------------------------------------------

def q01(p):
    return C.overview(p, {
        "passenger_count": F.count(F.lit(1)), "unique_passengers": F.count_distinct("PassengerId"),
        "passenger_classes": F.count_distinct("Pclass"), "survival_rate_percent": X.rate_pct("Survived"),
        "missing_age_count": X.count_when(F.col("Age").isNull()),
        "missing_cabin_count": X.count_when(X.sql_blank("Cabin")),
        "missing_embarkation_count": X.count_when(X.sql_blank("Embarked")),
        "missing_fare_count": X.count_when(F.col("Fare").isNull())})


def q02(p):
    return C.share_of_total(p, F.col("Pclass").alias("passenger_class"), count_name="passenger_count",
                            share_name="dataset_share_percent").orderBy("passenger_class")


def q03(p):
    return C.profile_join(class_profile(p), p, "passenger_class", "Pclass",
                          {"survival_rate_percent": X.rate_pct("Survived")}).orderBy("passenger_class")


def q04(p):
    return C.outcome_rate(p, [F.col("Pclass").alias("passenger_class"), F.col("Sex").alias("sex")], "Survived",
                          count_name="passenger_count", positive_name="survivor_count",
                          negative_name="non_survivor_count", rate_name="survival_rate_percent").orderBy(
        "passenger_class", "sex")


def q05(p):
    out = C.numeric_stats(p, F.col("Pclass").alias("passenger_class"), "Fare", prefix="fare")
    return out.select("passenger_class", F.col("fare_count").alias("passengers_with_fare"),
                      F.col("fare_min").alias("minimum_fare"), F.col("fare_avg").alias("average_fare"),
                      F.col("fare_max").alias("maximum_fare"), F.col("fare_variance").alias("fare_variance")).orderBy(
        "passenger_class")


def q06(p):
    out = C.banded_profile(p, F.col("Pclass").alias("passenger_class"), "Age",
                           [("child_count", None, 18), ("adult_count", 18, 60), ("senior_count", 60, None)],
                           prefix="age")
    return out.select("passenger_class", F.col("row_count").alias("passenger_count"),
                      F.col("age_known_count").alias("passengers_with_known_age"),
                      F.col("age_missing_count").alias("missing_age_count"), F.col("age_avg").alias("average_age"),
                      F.col("age_min").alias("youngest_age"), F.col("age_max").alias("oldest_age"),
                      "child_count", "adult_count", "senior_count").orderBy("passenger_class")


def q07(p):
    return embarkation_class_mix(p).orderBy("embarkation_port", "passenger_class")


def q08(p):
    return C.group_profile(p, X.coalesce_default("Embarked", "Unknown").alias("embarkation_port"), {
        "average_passenger_class": X.rounded_avg("Pclass"), "average_fare": X.rounded_avg("Fare"),
        "survival_rate_percent": X.rate_pct("Survived"), "percent_with_cabin": X.rate_pct("HasCabin")},
        count_name="passenger_count", order_by=[F.col("passenger_count").desc()])


def q09(p):
    return C.order_by_list(family_profile(p), "family_size_group", FAMILY_GROUP_ORDER, "passenger_class")


def q10(p):
    return C.group_profile(p, F.col("FamilySizeGroup").alias("family_size_group"), {
        "average_family_size": X.rounded_avg("FamilySize"), "average_fare": X.rounded_avg("Fare"),
        "average_passenger_class": X.rounded_avg("Pclass"), "survival_rate_percent": X.rate_pct("Survived"),
        "percent_travelling_alone": X.rate_pct("IsAlone")},
        count_name="passenger_count", order_by=[F.col("passenger_count").desc()])


def q11(p):
    return cabin_profile(p).orderBy("cabin_deck", "passenger_class")


def q12(p):
    prof = C.group_profile(p, "HasCabin", {
        "average_passenger_class": X.rounded_avg("Pclass"), "average_fare": X.rounded_avg("Fare"),
        "average_age": X.rounded_avg("Age"), "survival_rate_percent": X.rate_pct("Survived")},
        count_name="passenger_count")
    status = F.when(F.col("HasCabin") == 1, "Cabin recorded").otherwise("No cabin recorded").alias("cabin_status")
    return prof.orderBy(F.col("HasCabin").desc()).select(status, "passenger_count", "average_passenger_class",
                                                         "average_fare", "average_age", "survival_rate_percent")


def q13(p):
    return C.group_profile(p, F.col("Title").alias("passenger_title"), {
        "average_passenger_class": X.rounded_avg("Pclass"), "average_age": X.rounded_avg("Age"),
        "average_fare": X.rounded_avg("Fare"), "survival_rate_percent": X.rate_pct("Survived")},
        count_name="passenger_count", order_by=[F.col("passenger_count").desc(), F.col("passenger_title")])


def q14(p):
    return C.group_profile(p, F.col("TicketPrefix").alias("ticket_prefix"), {
        "average_passenger_class": X.rounded_avg("Pclass"), "average_fare": X.rounded_avg("Fare"),
        "survival_rate_percent": X.rate_pct("Survived")},
        count_name="passenger_count", having=F.col("passenger_count") >= 3,
        order_by=[F.col("passenger_count").desc(), F.col("ticket_prefix")], limit=20)


def q15(p):
    cols = [F.col("PassengerId").alias("passenger_id"), F.col("Name").alias("passenger_name"),
            F.col("Pclass").alias("passenger_class"), F.col("Sex").alias("sex"), F.col("Age").alias("age"),
            F.col("Fare").alias("fare"), F.col("Cabin").alias("cabin"), F.col("CabinDeck").alias("cabin_deck"),
            F.col("TicketPrefix").alias("ticket_prefix"), F.col("Survived").alias("survived")]
    return C.top_k(p, [F.col("fare").desc(), F.col("passenger_id")], 20, not_null=["Fare"], columns=cols)


def q16(p):
    cols = [F.col("PassengerId").alias("passenger_id"), F.col("Name").alias("passenger_name"),
            F.col("Pclass").alias("passenger_class"), F.col("FamilySize").alias("family_size"),
            F.col("FamilySizeGroup").alias("family_size_group"), F.col("SibSp").alias("siblings_or_spouses"),
            F.col("Parch").alias("parents_or_children"), F.col("Fare").alias("fare"),
            F.col("Survived").alias("survived")]
    return C.top_k(p, [F.col("family_size").desc(), F.col("fare").desc(), F.col("passenger_id")], 25, columns=cols)


def q17(p):
    return C.overview(p, {
        "average_family_size": X.rounded_avg("FamilySize", 3), "minimum_family_size": F.min("FamilySize"),
        "maximum_family_size": F.max("FamilySize"), "percent_alone": X.rate_pct("IsAlone"),
        "percent_with_cabin": X.rate_pct("HasCabin"), "average_cabin_count": X.rounded_avg("CabinCount", 3),
        "maximum_cabin_count": F.max("CabinCount"), "average_log_fare": X.rounded_avg("FareLog", 3),
        "minimum_log_fare": F.round(F.min("FareLog"), 3), "maximum_log_fare": F.round(F.max("FareLog"), 3)})


def q18(p):
    return C.missing_by_group(p, F.col("Pclass").alias("passenger_class"), {
        "missing_age": (F.col("Age").isNull(), True), "missing_cabin": (X.sql_blank("Cabin"), True),
        "missing_embarkation": (X.sql_blank("Embarked"), False)}, count_name="passenger_count").orderBy(
        "passenger_class")


def q19(p):
    return C.group_profile(p, F.col("Pclass").alias("passenger_class"), {
        "average_age": X.rounded_avg("Age"), "average_fare": X.rounded_avg("Fare"),
        "average_fare_log": X.rounded_avg("FareLog", 3), "average_family_size": X.rounded_avg("FamilySize"),
        "percent_alone": X.rate_pct("IsAlone"), "percent_with_cabin": X.rate_pct("HasCabin"),
        "average_cabin_count": X.rounded_avg("CabinCount")},
        count_name="passenger_count", order_by=["passenger_class"])


def q20(p):
    out = C.shared_keys(p, "Ticket", "Pclass", "Fare", key_name="ticket", k=30)
    return out.select("ticket", F.col("row_count").alias("passenger_count"),
                      F.col("distinct_categories").alias("represented_classes"),
                      F.col("average_value").alias("average_fare"),
                      F.col("categories").alias("passenger_classes"))


# Query names and descriptions of the analysis catalog.
ANALYSES = (
    ("01_dataset_overview", q01, "Dataset size, class coverage, survival rate and missing-value counts."),
    ("02_passenger_class_distribution", q02, "Passenger count and dataset share per class."),
    ("03_class_profile", q03, "Demographic, fare, family, cabin and survival profile per class."),
    ("04_survival_by_class_and_sex", q04, "Survival outcomes by class and sex."),
    ("05_fare_statistics_by_class", q05, "Fare statistics per class."),
    ("06_age_profile_by_class", q06, "Age coverage and age-band composition per class."),
    ("07_embarkation_class_mix", q07, "Class composition within each embarkation port."),
    ("08_embarkation_outcomes", q08, "Fare, class and survival by embarkation port."),
    ("09_family_profile", q09, "Class and fare by family-size group."),
    ("10_family_survival_profile", q10, "Survival and characteristics by family-size group."),
    ("11_cabin_profile", q11, "Passenger counts by cabin deck and class."),
    ("12_cabin_access_and_outcomes", q12, "Differences between passengers with and without a cabin record."),
    ("13_title_profile", q13, "Class, age, fare and survival by title."),
    ("14_ticket_prefix_profile", q14, "Most common ticket prefixes and their class association."),
    ("15_high_fare_passengers", q15, "The twenty highest fares."),
    ("16_largest_family_groups", q16, "Passengers of the largest family groups."),
    ("17_feature_summary", q17, "Summary of the engineered numeric and binary features."),
    ("18_missing_data_by_class", q18, "Missing-value counts and percentages per class."),
    ("19_class_prediction_feature_profile", q19, "Mean model features per class."),
    ("20_potential_duplicate_tickets", q20, "Tickets shared by several passengers."),
)


def analysis_catalog(table: str = "passengers") -> list[NamedQuery]:
    """The twenty analyses as named queries over the registered table."""
    return [NamedQuery(name, (lambda spark, fn=fn: fn(spark.table(table))), desc) for name, fn, desc in ANALYSES]
