"""The twenty named analyses on a 12-passenger fixture (fixture X6)."""

import json

import pytest

from strata.presets import passenger as P
from strata.sources import catalog as CAT

ROWS = [
    (1, 1, 1, "Allen, Mr. William", "male", 35.0, 0, 0, "PC 17599", 120.00, "C85", "C"),
    (2, 1, 1, "Brown, Mrs. Alice", "female", 38.0, 1, 0, "PC 17599", 120.00, "C123", "C"),
    (3, 0, 1, "Clark, Mr. Henry", "male", 62.0, 0, 0, "113803", 80.00, "B28", "S"),
    (4, 1, 2, "Davis, Miss. Emma", "female", 24.0, 0, 1, "SC PARIS 2167", 32.50, None, "S"),
    (5, 0, 2, "Evans, Mr. John", "male", 42.0, 0, 0, "248738", 13.00, None, "S"),
    (6, 1, 2, "Foster, Master. Tom", "male", 8.0, 1, 2, "C.A. 33112", 26.00, "F2", "S"),
    (7, 0, 3, "Green, Mr. Owen", "male", 21.0, 0, 0, "A/5 21171", 7.25, None, "S"),
    (8, 1, 3, "Hill, Miss. Mary", "female", 18.0, 0, 0, "STON/O2 3101282", 7.92, None, "Q"),
    (9, 0, 3, "Irwin, Mrs. Anna", "female", 29.0, 3, 2, "347082", 31.28, None, "S"),
    (10, 0, 3, "Jones, Mr. Peter", "male", None, 1, 0, "347082", 31.28, None, None),
    (11, 1, 1, "King, Mrs. Charlotte", "female", 48.0, 0, 0, "PC 17757", 512.33, "B51 B53 B55", "C"),
    (12, 0, 3, "Lewis, Master. Sam", "male", 4.0, 4, 2, "CA 2144", 46.90, None, "S"),
]
SCHEMA = ("PassengerId long, Survived long, Pclass long, Name string, Sex string, Age double, SibSp long, "
          "Parch long, Ticket string, Fare double, Cabin string, Embarked string")


@pytest.fixture(scope="module")
def catalog_run(spark, tmp_path_factory):
    passengers = P.prepare_passenger_data(spark.createDataFrame(ROWS, SCHEMA))
    P.register_views(spark, passengers)
    out = str(tmp_path_factory.mktemp("analyses"))
    results = CAT.run_analyses(spark, P.analysis_catalog(), out, required_tables=["passengers"])
    manifest = json.load(open(CAT.save_manifest(results, out, spark=spark)))
    return passengers, results, manifest


def run(spark, name):
    fn = {n: f for n, f, _ in P.ANALYSES}[name]
    return fn(spark.table("passengers")).collect()


def test_all_queries_run_and_manifest(spark, catalog_run):
    _, results, manifest = catalog_run
    names = [n for n, _, _ in P.ANALYSES]
    assert [r.name for r in results] == names and len(set(names)) == 20
    assert manifest["query_count"] == 20
    assert all(q["columns"] > 0 and q["rows"] >= 0 and q["column_names"] for q in manifest["queries"])
    assert all(desc for _, _, desc in P.ANALYSES)


def test_overview(spark, catalog_run):
    r = run(spark, "01_dataset_overview")[0]
    assert (r.passenger_count, r.unique_passengers, r.passenger_classes) == (12, 12, 3)
    assert r.missing_age_count == 1 and r.missing_embarkation_count == 1


def test_class_distribution(spark, catalog_run):
    rows = run(spark, "02_passenger_class_distribution")
    assert {r.passenger_class for r in rows} == {1, 2, 3}
    assert sum(r.passenger_count for r in rows) == 12
    assert abs(sum(r.dataset_share_percent for r in rows) - 100) <= 0.02


def test_high_fares_sorted(spark, catalog_run):
    rows = run(spark, "15_high_fare_passengers")
    fares = [r.fare for r in rows]
    assert fares == sorted(fares, reverse=True)
    assert rows[0].passenger_id == 11 and rows[0].fare == pytest.approx(512.33)


def test_shared_tickets(spark, catalog_run):
    rows = run(spark, "20_potential_duplicate_tickets")
    tickets = {r.ticket for r in rows}
    assert {"PC 17599", "347082"} <= tickets
    assert all(r.passenger_count > 1 for r in rows)


def test_embarkation_mix_excludes_null_port(spark, catalog_run):
    rows = run(spark, "07_embarkation_class_mix")
    assert all(r.embarkation_port is not None for r in rows)
    for port in {r.embarkation_port for r in rows}:
        assert abs(sum(r.percentage_within_port for r in rows if r.embarkation_port == port) - 100) <= 0.02


def test_quality_report_rules(spark):
    raw = spark.createDataFrame(ROWS + [(13, 1, 4, "Odd, Mr. X", "unknown", -1.0, 0, 0, "X 1", -5.0, None, "Z")],
                                SCHEMA)
    report = {(r.section, r.column, r.metric): r.value for r in P.quality_report(raw).collect()}
    assert report[("ranges", "*", "negative_age_rows")] == "1"
    assert report[("ranges", "*", "negative_fare_rows")] == "1"
    assert ("unexpected", "Pclass", "value") in report and ("unexpected", "Embarked", "value") in report
    assert report[("missing", "Age", "missing_count")] == "1"


def test_registered_views_match_dataframe_views(spark, catalog_run):
    passengers, _, _ = catalog_run
    P.register_views(spark, passengers)
    for name, fn in P.VIEWS.items():
        via_sql = spark.sql(f"SELECT * FROM {name}").collect()
        assert sorted(map(tuple, via_sql), key=str) == sorted(map(tuple, fn(passengers).collect()), key=str), name
