"""Vector codes against plain Lloyd rounds, and the trees' own promises."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from strata.llm import cover_codes
from strata.llm.common import ROW

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, points string, `a.b` int"


def plain(rows, parts, entries, rounds):
    """{(row number): (code, error)} and the codebooks, by exact comparison with every entry."""
    kept = [(i, r) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept = [(i, r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]]) for i, r in kept]
    sizes = [len(v) for _, _, v in kept if v and len(v) % parts == 0]
    length = max(set(sizes), key=lambda n: (sizes.count(n), n), default=0)
    most = cover_codes.largest(length // parts, entries)
    coded = [x for x in kept if len(x[2]) == length and all(abs(c) < most for c in x[2])]
    width = length // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted((x for x in coded if x[1] is not None), key=lambda x: (x[1], rows[x[0]][1]))[:entries]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((gap(cut(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        groups = [{} for _ in range(parts)]
        for _, _, v in coded:
            for p in range(parts):
                groups[p].setdefault(near(v, p)[1], []).append(cut(v, p))
        for p in range(parts):
            for k, g in groups[p].items():
                books[p][k] = [sum(c) // len(g) for c in zip(*g)]
    out = {i: (None, None) for i, _, _ in kept}
    for i, _, v in coded:
        found = [near(v, p) for p in range(parts)]
        out[i] = ("".join(f"{k:02x}" for _, k in found), sum(g for g, _ in found))
    return out, books


def messy():
    rng = random.Random(3)
    centre = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    vectors = [[c + rng.gauss(0, 0.2) for c in rng.choice(centre)] for _ in range(300)]
    vectors += [[0.5] * 8] * 200 + [[0.0] * 8] * 3  # a hot vector, and ties
    vectors += [None, [], [1.0] * 7, [1.0] * 16, [float("nan")] + [0.0] * 7, [float("inf")] + [0.0] * 7, [None] + [0.0] * 7,
                [1e9] + [0.0] * 7, [1e38] + [0.0] * 7]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], i % 3 or None, "x", 5, "y", 1)
            for i, v in enumerate(vectors)]
    rows += [rows[0], rows[0], (None, *rows[1][1:])]
    rng.shuffle(rows)
    return rows


def test_codes_equal_plain_lloyd(spark):
    rows = messy()
    for entries, rounds in ((16, 2), (4, 3)):
        want, books = plain(rows, 4, entries, rounds)
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + SCHEMA).repartition(3)
        got, found = cover_codes.vector_codes(df, "vec_id", "embedding", parts=4, entries=entries, rounds=rounds)
        assert found == books
        got = {r[ROW].i: (r.code, r.error) for r in got.collect()}
        assert got == want


def test_codes_do_not_depend_on_tiles(spark, monkeypatch):
    df = spark.createDataFrame(messy(), SCHEMA)
    one = sorted(map(str, cover_codes.vector_codes(df.coalesce(1), "vec_id", "embedding", 4, 16)[0].collect()))
    many = sorted(map(str, cover_codes.vector_codes(df.repartition(7), "vec_id", "embedding", 4, 16)[0].collect()))
    assert one == many


def test_no_vectors(spark):
    df = spark.createDataFrame([], SCHEMA)
    got, books = cover_codes.vector_codes(df, "vec_id", "embedding", 4)
    assert got.count() == 0 and books == [[], [], [], []]
    df = spark.createDataFrame([(None, [1.0] * 8, 1, "x", 5, "y", 1)], SCHEMA)
    got = cover_codes.vector_codes(df, "vec_id", "embedding", 4)[0].select(f"{ROW}.*", F.col("code").alias("c")).collect()
    assert [(r.c, r["a.b"]) for r in got] == [(None, 1)]


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c * 40, 6, (300, 4)) for c in range(6)] + [np.zeros((100, 4))]).astype(np.int64)
    tree = cover_codes.cover_tree(points)
    assert sorted(tree.order) == list(range(len(points)))
    laid = points[tree.order]
    lo, hi, first, many = tree.nodes
    for k in range(lo.size):
        far = np.sqrt(((laid[lo[k] : hi[k]] - laid[lo[k]]) ** 2).sum(1)).max()
        assert far <= tree.radius[k]
        kids = tree.kids[first[k] : first[k] + many[k]]
        if many[k]:
            spans = sorted((lo[c], hi[c]) for c in kids)
            assert spans[0][0] == lo[k] and spans[-1][1] == hi[k]
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    book = points[rng.choice(len(points), 64, replace=False)]
    (a, b, entry), (place, one), compared = cover_codes.walk(tree, laid, book)
    got = np.full(len(points), -1)
    for x, y, e in zip(a, b, entry):
        got[x:y] = e
    assert (got[place] == -1).all()
    got[place] = one
    exact = ((laid[:, None] - book[None]) ** 2).sum(2)
    assert (got == exact.argmin(1)).all()
    assert compared < 0.35 * len(points) * len(book)
