"""Distribution operators against pandas / numpy on small seeded data."""

import numpy as np
import pandas as pd
import pytest

from strata.operators import describe as D
from strata.operators import filters as FL
from strata.operators import quantiles


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    n = 500
    pdf = pd.DataFrame({
        "g": rng.choice(["a", "b", "c"], n),
        "h": rng.choice(["x", "y"], n),
        "v": np.round(rng.normal(50, 15, n), 2),
        "w": rng.integers(0, 20, n).astype(float),
    })
    pdf.loc[rng.choice(n, 40, replace=False), "v"] = np.nan
    sdf = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                                "g string, h string, v double, w double")
    return pdf, sdf


def test_describe_matches_pandas(frame):
    pdf, sdf = frame
    got = {r.column: r for r in D.describe_numeric(sdf, ["v", "w"], decimals=6).collect()}
    want = pdf[["v", "w"]].describe()
    for c in ("v", "w"):
        assert got[c]["count"] == want.loc["count", c]
        for stat, key in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                          ("p75", "75%"), ("max", "max")):
            assert got[c][stat] == pytest.approx(want.loc[key, c], abs=1e-6)


def test_group_summary_and_medians(frame):
    pdf, sdf = frame
    got = {r.g: r for r in D.group_summary(sdf, "g", "v", decimals=6).collect()}
    for g, part in pdf.groupby("g")["v"]:
        assert got[g].median == pytest.approx(part.median(), abs=1e-6)
        assert got[g].std == pytest.approx(part.std(), abs=1e-6)
    med = D.medians(sdf, ["v", "w"]).first()
    assert med.v == pytest.approx(pdf.v.median()) and med.w == pytest.approx(pdf.w.median())


def test_histogram_matches_numpy(frame):
    pdf, sdf = frame
    counts, edges = np.histogram(pdf.v.dropna(), bins=10)
    got = sorted((r.bin, r["count"]) for r in D.hist_width(sdf, "v", 10).collect())
    dense = [0] * 10
    for b, c in got:
        dense[b] = c
    assert dense == counts.tolist()


def test_box_stats(frame):
    pdf, sdf = frame
    got = {r.g: r for r in D.box_stats(sdf, "v", "g", decimals=6).collect()}
    for g, part in pdf.groupby("g")["v"]:
        vals = part.dropna().to_numpy()
        q1, q3 = np.percentile(vals, [25, 75])
        iqr = q3 - q1
        inside = vals[(vals >= q1 - 1.5 * iqr) & (vals <= q3 + 1.5 * iqr)]
        assert got[g].q1 == pytest.approx(q1, abs=1e-6) and got[g].q3 == pytest.approx(q3, abs=1e-6)
        assert got[g].whisker_low == pytest.approx(inside.min()) and got[g].whisker_high == pytest.approx(inside.max())


def test_crosstabs_match_pandas(frame):
    pdf, sdf = frame
    ct = {r.g: r for r in D.crosstab(sdf, "g", "h").collect()}
    want = pd.crosstab(pdf.g, pdf.h)
    for g in want.index:
        for h in want.columns:
            assert ct[g][h] == want.loc[g, h]
    norm = {r.g: r for r in D.crosstab_normalized(sdf, "g", "h", "columns", decimals=6).collect()}
    wantn = pd.crosstab(pdf.g, pdf.h, normalize="columns")
    for g in wantn.index:
        for h in wantn.columns:
            assert norm[g][h] == pytest.approx(wantn.loc[g, h], abs=1e-6)


def test_value_counts_and_mode(frame):
    pdf, sdf = frame
    vc = {r.value: r["count"] for r in D.value_counts(sdf, "w").collect()}
    assert vc == {k: v for k, v in pdf.w.value_counts().items()}
    m = D.mode_share(sdf, "w").first()
    counts = pdf.w.value_counts()
    assert m.mode == min(k for k, v in counts.items() if v == counts.max())


def test_search_and_reorder(spark):
    df = spark.createDataFrame([(1, "Alpha Beta", "x"), (2, "gamma", "BETA"), (3, "delta", None)],
                               "id long, a string, b string")
    assert sorted(r.id for r in FL.literal_search(df, "beta", ["a", "b"]).collect()) == [1, 2]
    assert sorted(r.id for r in FL.literal_search(df, "a.b", ["a"]).collect()) == []  # literal, not a pattern
    assert [r.id for r in FL.row_search(df, "3 delta").collect()] == [3]
    assert FL.reorder_columns(df, ["b", "zz", "id"]).columns == ["b", "id", "a"]


def test_narrowed_quantiles_match_pandas(frame):
    pdf, sdf = frame
    got = {r.column: r for r in D.describe_numeric(sdf, ["v", "w"], decimals=6).collect()}
    want = pdf[["v", "w"]].describe()
    for c in ("v", "w"):
        for stat, key in (("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("mean", "mean")):
            assert got[c][stat] == pytest.approx(want.loc[key, c], abs=1e-6)
    gs = {r.g: r.median for r in D.group_summary(sdf, "g", "v", decimals=6).collect()}
    for g, part in pdf.groupby("g")["v"]:
        assert gs[g] == pytest.approx(part.median(), abs=1e-6)


@pytest.mark.parametrize("held", [100_000, 40, 3])  # per-group tables as local rows, and as tables of the cluster
def test_quantiles_of_awkward_doubles(spark, monkeypatch, held):
    monkeypatch.setattr(quantiles, "BROADCAST_GROUPS", held)
    rng = np.random.default_rng(8)
    groups = {
        "tiny": [5e-324, -5e-324, 0.0, -0.0, 2.2e-308, 1e-310],
        "wide": [float(x) for x in rng.choice([-1.0, 1.0], 400) * 10.0 ** rng.uniform(-300, 300, 400)],
        "close": [1.0 + k * 2.0**-52 for k in range(300)] * 2,
        "powers": [x for k in range(-60, 60) for x in (2.0**k, np.nextafter(2.0**k, 0), -(2.0**k))],
        "endless": [float("inf"), float("-inf"), 1.0, 2.0, 3.0],
        "cents": [round(float(x), 2) for x in rng.uniform(0, 1e5, 3000)],
        "one": [7.5], "it's `odd`": [1.0, 2.0], None: [3.0, 4.0],
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("one", None), ("one", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, `o'v` double").repartition(3)
    ps = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = quantiles.quantile_arrays(df, ["o'v"], ps, ["g"], moments=True).collect()
    got = {r.g: r["values"] for r in found}
    assert set(got) == set(groups) and len(found) == len(groups)
    for r in found:
        if r.g not in ("endless", "wide"):
            own = np.array(groups[r.g])
            assert (r.n, r.least, r.most) == (own.size, own.min(), own.max())
            assert r.mean == pytest.approx(own.mean(), rel=1e-9, abs=1e-14 * abs(own).max())
            assert r.std == (None if own.size == 1 else pytest.approx(own.std(ddof=1), rel=1e-9, abs=1e-14 * abs(own).max()))
    assert quantiles.quantile_arrays(df.limit(0), ["o'v"], ps, ["g"], moments=True).count() == 0
    for g, vs in groups.items():
        vs = np.sort(np.array(vs))
        for p, v in zip(ps, got[g]):
            pos = p * (len(vs) - 1)
            lo, hi = vs[int(np.floor(pos))], vs[int(np.ceil(pos))]
            with np.errstate(invalid="ignore"):
                want = lo if lo == hi else lo + (hi - lo) * (pos - np.floor(pos))
            assert v == want or np.isnan([v, want]).all(), (g, p)
