from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators import cohort as C


def data(spark):
    rows = [(i, i % 3 + 1, "male" if i % 2 else "female", float(i) if i % 5 else None, i % 2,
             "S" if i % 4 else None, f"T{i % 6}") for i in range(1, 61)]
    return spark.createDataFrame(rows, "id long, cls long, sex string, fare double, flag int, port string, ticket string")


def test_share_of_total_sums_to_100(spark):
    out = C.share_of_total(data(spark), "cls").collect()
    assert abs(sum(r.share_percent for r in out) - 100) < 0.02
    assert sum(r.row_count for r in out) == 60


def test_share_within_drops_null_outer(spark):
    out = C.share_within(data(spark), "port", "cls").collect()
    assert all(r.port is not None for r in out)
    assert abs(sum(r.share_within_percent for r in out) - 100) < 0.02


def test_group_profile_keeps_null_group(spark):
    out = C.group_profile(data(spark), "port", {"avg_fare": X.rounded_avg("fare")}).collect()
    assert {r.port for r in out} == {"S", None}


def test_top_k_order_and_tiebreak(spark):
    out = C.top_k(data(spark), [F.col("fare").desc(), F.col("id")], 5, not_null=["fare"]).collect()
    assert [r.fare for r in out] == sorted([r.fare for r in out], reverse=True)
    assert out[0].id == 59


def test_shared_keys(spark):
    out = C.shared_keys(data(spark), "ticket", "cls", "fare", k=3).collect()
    assert len(out) == 3 and all(r.row_count == 10 for r in out)
    assert [r.shared_key for r in out] == ["T0", "T1", "T2"]


def test_missing_by_group_and_banded(spark):
    m = C.missing_by_group(data(spark), "cls", {"fare": (F.col("fare").isNull(), True)}).collect()
    assert sum(r.fare_count for r in m) == 12
    b = C.banded_profile(data(spark), "cls", "fare", [("low", None, 20), ("high", 20, None)]).collect()
    assert sum(r.low + r.high + r.value_missing_count for r in b) == 60


def test_averages_through_join_equals_join_then_aggregate(spark):
    facts = spark.createDataFrame([(k % 7, float(k), k % 3) for k in range(200)] + [(99, 5.0, 1)],
                                  "k long, v double, f int")
    dim = spark.createDataFrame([(k, "g" + str(k % 2)) for k in range(6)], "k long, g string")
    got = {r.g: (r.avg_v, r.rate) for r in C.averages_through_join(
        facts, "k", dim, "k", "g", {"avg_v": (F.col("v"), 1.0, 6), "rate": ((F.col("f") == 1).cast("double"), 100.0, 6)})
        .collect()}
    joined = facts.join(dim, "k")
    want = {r.g: (r.avg_v, r.rate) for r in joined.groupBy("g").agg(
        F.round(F.avg("v"), 6).alias("avg_v"), F.round(100.0 * F.avg((F.col("f") == 1).cast("double")), 6).alias("rate"))
        .collect()}
    assert got == want
