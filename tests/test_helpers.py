import pytest
from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators import describe as D
from strata.operators import joins as J
from strata.operators import quality as Q
from strata.operators import quantiles as QN
from strata.operators import setops as S


def test_set_operations(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (None,), (5,)], "v long")
    allowed = spark.createDataFrame([(2,), (3,)], "v long")
    assert [r.value for r in S.values_outside(a, "v", allowed).collect()] == [1, 5]
    assert [r.value for r in S.values_outside(a, "v", [1]).collect()] == [2, 5]
    b = spark.createDataFrame([(7,), (1,)], "p long")
    assert [r.label for r in S.label_union(a, "v", b, "p").collect()] == [1, 2, 5, 7]


def test_one_to_one_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    right = spark.createDataFrame([(1, "r")], "id long, y string")
    assert sorted((r.id, r.y) for r in J.left_join_one_to_one(left, right, ["id"]).collect()) == [(1, "r"), (2, None)]
    dup = spark.createDataFrame([(1, "r"), (1, "s")], "id long, y string")
    with pytest.raises(ValueError, match="right side"):
        J.left_join_one_to_one(left, dup, ["id"])


def test_pivot_width_guard(spark):
    df = spark.range(0, 50).selectExpr("id % 2 AS r", "id AS c")
    with pytest.raises(ValueError, match="distinct values"):
        D._distinct_values(df, "c", limit=10)
    assert len(D.crosstab(df, "r", "c", values=[0, 1]).columns) == 3


def test_approximate_quantiles(spark):
    df = spark.range(0, 10001).selectExpr("CAST(id AS DOUBLE) AS v")
    q = {r.p: r.value for r in QN.quantiles_long(df, ["v"], [0.5, 0.9], accuracy=10000).collect()}
    assert abs(q[0.5] - 5000) <= 2 and abs(q[0.9] - 9000) <= 2


def test_numeric_coercion_and_bounds(spark):
    df = spark.createDataFrame([("1", "a"), ("2.5", "b"), ("x", "c"), ("4", None), ("5", "e")], "n string, s string")
    out = Q.coerce_numeric_like(df)
    assert dict(out.dtypes)["n"] == "double" and dict(out.dtypes)["s"] == "string"
    b = Q.value_bounds(out, ["n"]).first()
    assert (b.min_value, b.max_value) == (1.0, 5.0)
    assert [r.value for r in Q.available_values(df, "s").collect()] == ["a", "b", "c", "e"]


def test_small_column_helpers(spark):
    df = spark.createDataFrame([([3, 1], 2, " Yes "), ([], 9, "no"), (None, 1, None)], "ids array<long>, c int, y string")
    rows = df.select(X.ids_json(F.array_sort("ids")).alias("j"), X.class_display_name("c").alias("n"),
                     X.yes_no_code("y").alias("y")).collect()
    assert [r.j for r in rows] == ["[1, 3]", "[]", "[]"]
    assert [r.n for r in rows] == ["Second class", "Class 9", "First class"]
    assert [r.y for r in rows] == [1, 0, None]
    bad = spark.createDataFrame([("maybe",)], "y string")
    with pytest.raises(Exception, match="Unexpected yes/no value"):
        bad.select(X.yes_no_code("y")).collect()


def test_wide_crosstab_gives_its_cells(spark, monkeypatch):
    monkeypatch.setattr(D, "_distinct_values", lambda df, c, f=D._distinct_values: f(df, c, 10))
    df = spark.range(0, 50).selectExpr("id % 2 AS r", "id % 25 AS c")
    assert {(x.r, x.c, x["count"]) for x in D.crosstab(df, "r", "c").collect()} == {(i % 2, i % 25, 1) for i in range(50)}
    shares = D.crosstab_normalized(df, "r", "c", "index").collect()
    assert len(shares) == 50 and {x.fraction for x in shares} == {0.04}
