"""Property tests: exact ranks, row numbers and quantiles against brute
force on random small inputs."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import quantiles as QN
from strata.operators.rows import with_row_number
from strata.operators.split import hash_rank

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=60)


@SETTINGS
@given(rows=rows_strategy, parts=st.integers(1, 5))
def test_hash_rank_is_exact(spark, rows, parts):
    data = [(i, g, v * 2**57) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, g long, v long").repartition(parts)
    got = {r.id: r.rank for r in hash_rank(df, "g", F.col("v"), ["id"], bits=4).collect()}
    expect = {}
    for g in {g for _, g, _ in data}:
        members = sorted((v % 2**64, i) for i, gg, v in data if gg == g)
        expect.update({i: k for k, (_, i) in enumerate(members)})
    assert got == expect


@SETTINGS
@given(n=st.integers(1, 300), parts=st.integers(1, 6))
def test_row_numbers(spark, n, parts):
    df = spark.range(0, n, numPartitions=parts)
    assert sorted(r.rn for r in with_row_number(df, "rn").collect()) == list(range(1, n + 1))


@SETTINGS
@given(rows=rows_strategy)
def test_quantiles_match_numpy(spark, rows):
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g long, v double")
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.p): r.value for r in QN.quantiles_long(df, ["v"], ps, ["g"]).collect()}
    for g in {g for g, _ in rows}:
        vals = np.array([v for gg, v in rows if gg == g], dtype=float)
        for p in ps:
            assert abs(got[(g, p)] - np.percentile(vals, p * 100)) < 1e-9


pairs_strategy = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3)), min_size=1,
                          max_size=60)


@SETTINGS
@given(rows=pairs_strategy)
def test_share_within_matches_brute_force(spark, rows):
    from strata.operators.cohort import share_within
    df = spark.createDataFrame(rows, "o string, i long")
    got = {(r.o, r.i): (r.row_count, r.share_within_percent) for r in share_within(df, "o", "i").collect()}
    expect = {}
    for o in {o for o, _ in rows if o is not None}:
        members = [i for oo, i in rows if oo == o]
        for i in set(members):
            n = members.count(i)
            expect[(o, i)] = (n, round(100.0 * n / len(members), 2))
    assert got.keys() == expect.keys()
    for k in expect:
        assert got[k][0] == expect[k][0] and abs(got[k][1] - expect[k][1]) < 1e-9


labels_strategy = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2)), min_size=1, max_size=80)


@SETTINGS
@given(pairs=labels_strategy)
def test_metrics_match_brute_force(spark, pairs):
    from strata.operators.evaluate import confusion_counts, metrics_from_confusion
    df = spark.createDataFrame(pairs, "y long, p long")
    m = metrics_from_confusion(confusion_counts(df, "y", "p")).first()
    labels = sorted({a for a, _ in pairs} | {b for _, b in pairs})
    n = len(pairs)
    acc = sum(a == b for a, b in pairs) / n
    recalls, f1s = [], []
    for c in labels:
        tp = sum(a == c and b == c for a, b in pairs)
        support = sum(a == c for a, _ in pairs)
        predicted = sum(b == c for _, b in pairs)
        prec = tp / predicted if predicted else 0.0
        rec = tp / support if support else 0.0
        if support:
            recalls.append(rec)
        f1s.append(2 * prec * rec / (prec + rec) if prec + rec else 0.0)
    assert abs(m.accuracy - acc) < 1e-12
    assert abs(m.balanced_accuracy - sum(recalls) / len(recalls)) < 1e-12
    assert abs(m.f1_macro - sum(f1s) / len(f1s)) < 1e-12
