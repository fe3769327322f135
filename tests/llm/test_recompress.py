"""Runs against brute force, the grammar's own promises, and the registered query."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from strata.llm import recompress
from strata.llm.common import ROW
from strata.llm.registry import QUERIES

SCHEMA = "doc_id long, text string, runs string, n_words int, collapsed string, `a b` int"


def plain_runs(w, exponent=4, least=6):
    """Maximal stretches of each period, the least period for equal ends."""
    found = {}
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i - s + p >= max(least, exponent * p) and i > s:
                found.setdefault((s, i - s + p), p)
            i += i == s
    return sorted((s, n, p) for (s, n), p in found.items())


def periodic(rng, n):
    k, out = rng.choice([1, 2, 3, 50]), []
    while len(out) < n:
        out += [rng.randrange(k) for _ in range(rng.randint(1, 12))] * rng.randint(1, 9)
        if rng.random() < 0.3:
            out *= 2
    return out[:n]


def messy():
    rng = random.Random(2)
    texts = [" ".join(f"w{x}" for x in periodic(rng, rng.choice([1, 5, 6, 7, 40, 300]))) for _ in range(60)]
    texts += [None, "", " \n\t ", "a", "a a a a a a", "a\x0ba\r\na a\ta  a", "A a A a A a A a", "é é é é é é é", "x\x85y " * 9,
              "nbsp\xa0nbsp " * 6, "w " * 20_000, "one two three " * 3_000, " ".join(f"u{i}" for i in range(9_000)), "y" * 100_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (None, texts[4]), (None, None)]
    rng.shuffle(rows)
    return [(*r, "x", 1, "y", 2) for r in rows]


ROWS = messy()


def collapse(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_equal_brute_force(monkeypatch):
    rng = random.Random(1)
    for _ in range(150):
        docs = [periodic(rng, rng.choice([0, 1, 2, 5, 6, 7, 30, 100, 300])) for _ in range(rng.randint(0, 8))]
        monkeypatch.setattr(recompress, "CHUNK", rng.choice([1, 7, 1000, 1 << 20]))
        exponent, least = rng.choice([2, 3, 4]), rng.choice([2, 6])
        sizes, flat = np.array([len(d) for d in docs], np.int64), np.array([x for d in docs for x in d], np.int64)
        got = list(zip(*[c.tolist() for c in recompress.periodic_runs(flat, sizes, exponent, least)]))
        assert got == [(i, *r) for i, d in enumerate(docs) for r in plain_runs(d, exponent, least)]


def separated(docs):
    out = [-1]
    for i, d in enumerate(docs):
        out += [*d, -2 - i]
    return np.array(out, np.int64)


@pytest.mark.parametrize("docs", [[[0] * 5000], [[0, 1] * 3000], [list(range(4000))], [[], [3], [1, 1], []]])
def test_grammar_gives_the_words_back(docs):
    symbols = separated(docs)
    grammar = recompress.recompress(symbols)
    top = grammar.levels[-1].symbols.tolist()
    assert [w for x in top for w in grammar.expand(x)] == symbols.tolist()
    assert len(top) <= 3 * (len(docs) + 1)


def test_extensions_both_ways():
    rng = random.Random(4)
    docs = [periodic(rng, 400) for _ in range(4)]
    symbols = separated(docs)
    grammar = recompress.recompress(symbols)
    inner = np.flatnonzero(symbols >= 0)
    i, j = np.array(rng.choices(inner.tolist(), k=3000)), np.array(rng.choices(inner.tolist(), k=3000))
    i, j = i[i != j], j[i != j]
    ahead, behind = recompress.extensions(grammar, i, j), recompress.extensions(grammar, i, j, back=True)
    s = symbols.tolist()
    for a, b, f, g in zip(i.tolist(), j.tolist(), ahead.tolist(), behind.tolist()):
        n = 0
        while s[a + n] == s[b + n]:
            n += 1
        m = 0
        while s[a - 1 - m] == s[b - 1 - m]:
            m += 1
        assert (f, g) == (n, m)


def test_operator_on_messy_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = sorted(str((r[ROW].doc_id, r[ROW]["a b"], r.n_words, [tuple(x) for x in r.runs], r.collapsed))
                 for r in recompress.find_runs(df, batch_bytes=4000).collect())
    want = []
    for doc_id, text, *_ in ROWS:
        words = (text or "").encode().split()
        runs = [] if len(set(words)) == len(words) else plain_runs(words) if len(words) < 9000 else None
        if runs is None:  # one run all through, from its first period on
            p = len(set(words))
            runs = [(0, len(words), p)]
        want.append(str((doc_id, 2, len(words), runs, collapse(words, runs).decode())))
    assert got == sorted(want)
    assert recompress.find_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registered_query(spark, tmp_path):
    rows = [r[:2] for r in ROWS if r[0] is not None and len(r[1] or "") < 9000]
    rows += [(1000 + i, " ".join(f"v{(i * k) % 37}" for k in range(i))) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op11_recompression_runs"].build(spark, str(tmp_path)).collect()]
    want, planted = [], 0
    for doc_id, text in rows:
        w = (text or "").encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = plain_runs(w)
        s, m, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        want.append((doc_id, len(runs), s, m, q, None if s is None else 1000 * m // q,
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapse(w, runs)).hexdigest()))
    assert planted > 10 and sorted(map(str, got)) == sorted(map(str, want))
