import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators.rows import with_row_number


def test_require_columns_lists_sorted(spark):
    df = spark.createDataFrame([(1,)], "a long")
    with pytest.raises(ValueError, match="b, c"):
        Q.require_columns(df, {"c", "b", "a"})


def test_missing_profile_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, "y")], "a long, b string")
    mp = {r.column: r.missing_count for r in Q.missing_profile(df).collect()}
    assert mp == {"b": 2, "a": 1}
    d = Q.duplicate_rows(df).first()
    assert (d.row_count, d.distinct_rows, d.duplicate_rows) == (4, 3, 1)


def test_duplicate_ids(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id long")
    r = Q.duplicate_ids(df, "id").first()
    assert (r.null_ids, r.duplicated_ids, r.duplicated_rows, list(r.example_ids)) == (1, 1, 2, [1])
    with pytest.raises(ValueError):
        Q.validate_ids(df, "id")


def test_strict_integer(spark):
    ok = spark.createDataFrame([("1",), ("2.0",), (None,)], "v string")
    assert [r.o for r in ok.select(Q.strict_integer(ok, "v").alias("o")).collect()] == [1, 2, None]
    bad = spark.createDataFrame([("1.5",)], "v string")
    with pytest.raises(ValueError, match="non-integer"):
        Q.strict_integer(bad, "v")
    junk = spark.createDataFrame([("abc",)], "v string")
    with pytest.raises(ValueError, match="cannot be converted"):
        Q.strict_integer(junk, "v")


def test_unexpected_and_numeric_like(spark):
    df = spark.createDataFrame([("male", "1"), ("FEMALE", "x"), ("female", "3"), (None, "4"), ("male", "5")],
                               "sex string, n string")
    uv = [(r.column, r.value) for r in Q.unexpected_values(df, {"sex": ["male", "female"]}).collect()]
    assert uv == [("sex", "FEMALE")]
    nl = {r.column: r.is_numeric for r in Q.numeric_like(df).collect()}
    assert nl == {"sex": False, "n": True}


def test_row_numbers_are_consecutive(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumnRenamed("id", "x")
    rows = with_row_number(df, "rn").collect()
    assert sorted(r.rn for r in rows) == list(range(1, 1001))
    assert all(r.rn == r.x + 1 for r in rows)


def test_empty_inputs_do_not_fail(spark):
    from strata.operators import cohort as C
    from strata.operators import describe as D
    empty = spark.createDataFrame([], "a long, b string, v double")
    assert {r.missing_count for r in Q.missing_profile(empty, only_missing=False).collect()} == {0}
    assert C.share_of_total(empty, "b").collect() == []
    assert D.describe_numeric(empty, ["v"]).first()["count"] == 0


def test_type_profile_exact_and_approx(spark):
    df = spark.range(0, 5000).selectExpr("id", "id % 7 AS m", "CAST(id % 3 AS STRING) AS s")
    exact = {r.column: r.distinct_count for r in Q.type_profile(df).collect()}
    assert exact == {"id": 5000, "m": 7, "s": 3}
    approx = {r.column: r.distinct_count for r in Q.type_profile(df, relative_sd=0.02).collect()}
    assert approx["m"] == 7 and approx["s"] == 3 and abs(approx["id"] - 5000) < 500


def test_row_numbers_after_shuffle(spark):
    df = spark.range(0, 500, numPartitions=4).groupBy((F.col("id") % 50).alias("k")).count()
    rows = with_row_number(df, "rn").collect()
    assert sorted(r.rn for r in rows) == list(range(1, 51))


def test_integers_beyond_double_precision_stay_exact(spark):
    from strata.operators import quality as Q
    df = spark.createDataFrame([("9007199254740993",), ("9007199254740992",), ("7.0",), (None,)], "id string")
    for strict in (True, False):
        got = {r.id for r in Q.standardize_types(df, integers=["id"], strict=strict).collect()}
        assert got == {9007199254740993, 9007199254740992, 7, None}


def test_numeric_range_reaches_the_scan(spark, tmp_path):
    from strata.operators.filters import FilterSpec, apply_filters
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "cast(id as double) v").write.parquet(path)
    out = apply_filters(spark.read.parquet(path), FilterSpec(ranges={"v": (3, 5)}))
    assert out.count() == 3
    assert "GreaterThanOrEqual(v" in out._jdf.queryExecution().executedPlan().toString()


def test_quality_report_is_one_scan_and_reports_empty_tables(spark, tmp_path):
    rows = [(1, "a", 1.5, {"k": 1}), (1, "a", 1.5, {"k": 1}), (2, None, float("nan"), None), (None, "b", -1.0, {"k": 2})]
    df = spark.createDataFrame(rows, "id long, kind string, `x y` double, m map<string,int>")
    df.write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))

    def report(d):
        out = Q.quality_report(d, id_column="id", expected={"kind": ["a"], "absent": [1]}, ranges={"negative": F.col("`x y`") < 0})
        found = sorted((r.section, r.column, r.metric, r.value) for r in out.collect())
        return found, out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    found, plan = report(read)
    assert plan.count("FileScan") == 1
    assert found == sorted([
        ("shape", "*", "rows", "4"), ("shape", "*", "columns", "4"), ("duplicates", "*", "duplicate_rows", "1"),
        ("duplicates", "id", "duplicated_ids", "1"), ("unexpected", "kind", "value", "b"), ("ranges", "*", "negative", "1"),
        *[x for c in ("id", "kind", "m") for x in (("missing", c, "missing_count", "1"), ("missing", c, "missing_percent", "25.0"))],
        *[("types", c, "dtype", t) for c, t in (("id", "bigint"), ("kind", "string"), ("x y", "double"), ("m", "map<string,int>"))],
        *[("types", c, "distinct_count", n) for c, n in (("id", "2"), ("kind", "2"), ("x y", "3"), ("m", "2"))]])
    empty, _ = report(read.limit(0))
    assert {(s, c, m): v for s, c, m, v in empty if s != "types"} == {
        ("shape", "*", "rows"): "0", ("shape", "*", "columns"): "4", ("duplicates", "*", "duplicate_rows"): "0",
        ("duplicates", "id", "duplicated_ids"): "0", ("ranges", "*", "negative"): "0"}
    assert {v for s, c, m, v in empty if m == "distinct_count"} == {"0"}
