import json

import pytest

from strata.sources import catalog as CAT
from strata.sources import io as IO


def test_select_queries(spark):
    qs = [CAT.sql_query(n, "SELECT 1 AS x") for n in ("a", "b", "c")]
    assert [q.name for q in CAT.select_queries(qs, ["c", "a"])] == ["a", "c"]
    with pytest.raises(ValueError):
        CAT.select_queries(qs, ["zzz"])
    with pytest.raises(ValueError):
        CAT.select_queries(qs, ["a", "a"])
    with pytest.raises(ValueError):
        CAT.validate_catalog(qs + [CAT.sql_query("a", "SELECT 2")])
    with pytest.raises(ValueError):
        CAT.sql_query("bad name;", "SELECT 1")


def test_run_analyses_and_manifest(spark, tmp_path):
    spark.range(10).createOrReplaceTempView("nums")
    qs = [CAT.sql_query("evens", "SELECT id FROM nums WHERE id % 2 = 0", "even ids"),
          CAT.sql_query("total", "SELECT COUNT(*) AS n FROM nums")]
    results = CAT.run_analyses(spark, qs, str(tmp_path), required_tables=["nums"])
    assert [(r.name, r.rows) for r in results] == [("evens", 5), ("total", 1)]
    path = CAT.save_manifest(results, str(tmp_path))
    assert json.load(open(path))["query_count"] == 2
    broken = [CAT.sql_query("broken", "SELECT nope FROM nums")]
    with pytest.raises(RuntimeError, match="broken"):
        CAT.run_analyses(spark, broken, str(tmp_path))


def test_csv_and_table_io(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('PassengerId,Name,Age\n1,"Braund, Mr. Owen",22\n2,"Cumings, Mrs. J",\n')
    df = IO.load_table(spark, str(p))
    rows = df.collect()
    assert rows[0].Name == "Braund, Mr. Owen" and rows[1].Age is None
    with pytest.raises(ValueError):
        IO.load_table(spark, str(tmp_path / "t.xlsx"))
    with pytest.raises(FileNotFoundError):
        IO.read_parquet(spark, str(tmp_path / "missing.parquet"))
    IO.write_table(df, "people", temporary=True)
    assert IO.query(spark, "SELECT Name FROM people WHERE PassengerId = ?", [2]).first().Name == "Cumings, Mrs. J"
    assert ("people", "view") in [(r.name, r.type) for r in IO.list_objects(spark).collect()]
    assert IO.execute_script(spark, "-- views\nCREATE OR REPLACE TEMP VIEW v1 AS SELECT 1 AS a;\n"
                                    "CREATE OR REPLACE TEMP VIEW v2 AS SELECT 2 AS b;") == 2


def test_invalid_sql_raises(spark):
    from pyspark.errors import AnalysisException, ParseException
    with pytest.raises((AnalysisException, ParseException)):
        IO.query(spark, "SELEC nothing FROM nowhere").collect()
    with pytest.raises(AnalysisException):
        IO.query(spark, "SELECT missing_column FROM range(3)").collect()


def test_parallel_catalog_keeps_order(spark, tmp_path):
    spark.range(100).createOrReplaceTempView("nums2")
    qs = [CAT.sql_query(f"q{i}", f"SELECT id FROM nums2 WHERE id % {i + 2} = 0") for i in range(6)]
    results = CAT.run_analyses(spark, qs, str(tmp_path), parallelism=3)
    assert [r.name for r in results] == [f"q{i}" for i in range(6)]
    assert [r.rows for r in results] == [len(range(0, 100, i + 2)) for i in range(6)]
    with pytest.raises(RuntimeError, match="bad"):
        CAT.run_analyses(spark, qs + [CAT.sql_query("bad", "SELECT nope FROM nums2")], str(tmp_path), parallelism=3)
