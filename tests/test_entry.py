import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(sql) >= 90


def test_some_queries_match_expected_shapes(spark):
    qs = E.queries()
    out = qs["share_of_total"](spark, "/root/testdata/sf0.001").collect()
    assert abs(sum(r.share_percent for r in out) - 100) < 0.05
    assert qs["top_k"](spark, "/root/testdata/sf0.001").count() == 20
