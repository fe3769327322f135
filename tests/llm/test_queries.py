"""Registered queries and the pipeline's stages against plain Python, over small
tables that hold nulls, empty texts, repeated rows, planted copies, passages,
benchmark windows and boilerplate of several hosts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers

import corpus_pipeline
from strata.llm import decontaminate, line_quality
from strata.llm.registry import QUERIES

from .test_operators import area, brute_components, brute_phrases, brute_print, lower_words, sentence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id int, digest string, spans string"
BLANK = rb"[\x20\x09-\x0d]+"


def planted_rows():
    rng = random.Random(9)
    passage, leak = sentence(rng, 55), sentence(rng, 14)
    footers = {h: f"Footer of {h}:  all   rights reserved" for h in ("h1", "h2")}
    texts = []
    for i in range(60):
        host = ("h1", "h2", "h3", None)[i % 4]
        body = [sentence(rng, rng.randint(12, 25)) for _ in range(3)]
        if i % 5 == 0:
            body[1] += " " + passage
        if i % 13 == 0:
            body[0] = leak + " " + body[0]
        if host in footers:
            body.append(footers[host])
        texts.append(("\n".join(body), host))
    texts += [texts[3], texts[3], texts[8], (texts[10][0] + " tail", "h3")]  # exact and near copies
    texts += [(footers["h1"] + "\n" + sentence(rng, 3), "h1"), ("a b c d e " * 20, "h1"), (None, "h1"), ("", "h2"), (" \n ", None)]
    rows = [(i, t, "xx", h, None if t is None else len(t), 1, "d", "s") for i, (t, h) in enumerate(texts)]
    rows += [rows[5], rows[5], (None, sentence(rng, 30), "xx", "h3", 1, 1, "d", "s")]
    rng.shuffle(rows)
    return rows, [(1, leak), (2, sentence(rng, 20)), (3, None), (4, "")]


ROWS, ITEMS = planted_rows()


def brute_quality(rows):
    def normal(line):
        return re.sub(BLANK, b" ", line).strip(b" ").lower()

    holders, texts = defaultdict(set), defaultdict(set)
    for r in rows:
        text = (r.text or "").encode()
        texts[r.source].add(text)
        for line in text.split(b"\n"):
            if line.split():
                holders[r.source, normal(line)].add(text)
    over = {k for k, own in holders.items() if len(own) > max(line_quality.MIN_DOCS, line_quality.SHARE * len(texts[k[0]]))}
    out = []
    for r in rows:
        text = (r.text or "").encode()
        words, lines = text.split(), text.split(b"\n")
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        again = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
        bad = [(r.source, normal(x)) in over for x in lines]
        gone = sum(len(x.split()) for x, b in zip(lines, bad) if b)
        if len(words) < 10 or 100 * len(again) > 20 * len(words) or len(words) - gone < line_quality.MIN_LEFT * len(words):
            continue
        out.append((r.doc_id, b"\n".join(x for x, b in zip(lines, bad) if not b).decode()))
    return Counter(out)


def brute_distinct(rows):
    prints = [brute_print(r.text, 4) for r in rows]
    groups = brute_components(set(prints), 4)
    best = {}
    for r, p in zip(rows, prints):
        key = (r.doc_id is None, r.doc_id or 0)
        if groups[p] not in best or key < best[groups[p]][0]:
            best[groups[p]] = (key, r)
    return Counter((r.doc_id, r.text) for _, r in best.values())


def has_leak(text):
    words = lambda t: (t or "").encode().translate(decontaminate.WORD_BYTES).split()
    own = words(text)
    for _, item in ITEMS:
        w = words(item)
        n = min(10, len(w))
        parts = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        if any(tuple(own[i : i + n]) in parts for i in range(len(own) - n + 1 if n else 0)):
            return True
    return False


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_every_stage_of_the_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    lost = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.collect(), stage(spark, docs, sf).cache()
        after = docs.collect()
        assert docs.columns == columns, name
        got = Counter((r.doc_id, r.text) for r in after)
        if name == "quality_rules":
            assert got == brute_quality(before)
        elif name == "near_duplicates":
            assert got == brute_distinct(before)
        elif name == "substring_dedup":
            want = Counter({k: n for k, n in brute_phrases([(r.doc_id, r.text) for r in before], 13).items() if k[1] > k[2]})
            kept = [(r.doc_id, hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest()) for r in after]
            assert Counter(kept) == Counter({(i, digest): n for (i, _, _, digest), n in want.items()})
            assert sum(k[2] for k in want) >= 55 * 8  # the planted passage, but for its first document
        else:
            assert got == Counter((r.doc_id, r.text) for r in before if not has_leak(r.text))
        if name in ("quality_rules", "substring_dedup"):
            assert all(r.n_chars == len(r.text) for r in after)
        lost.append(len(before) - len(after))
    assert all(n > 0 for i, n in enumerate(lost) if i != 2)
    own = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in docs.collect():
        want[r.doc_id, len(own.encode(r.text, add_special_tokens=False).ids) + 1] += 1
    pieces = corpus_pipeline.packing(spark, docs, sf).collect()
    assert Counter({(p.doc_id, p.doc_tokens): 1 for p in pieces}) == want
    assert sum(p.length for p in pieces) == sum(n for _, n in want)
    whole = corpus_pipeline.run(spark, sf).collect()
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32) for p in whole) == Counter((p.doc_id, p.start, p.length, p.ids_crc32) for p in pieces)


def test_pipeline_of_an_empty_table(spark, sf, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_op1(spark, sf):
    got = QUERIES["op1_brown_lm"].build(spark, sf).collect()
    fold = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter()
    for r in ROWS:
        if not fold(r[0]):
            counts.update(lower_words(r[1]) + [b"\n"])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for r in ROWS:
        words = lower_words(r[1]) + [b"\n"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        want[r[0], fold(r[0]), len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_op3(spark, tmp_path):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(900):
        words = sentence(rng, 30).split()
        if i % 4 == 0:
            words[rng.randrange(30)] = rng.choice(["vile", "rotten", "nasty"])
        rows.append((i, " ".join(words), "xx", "s", 1))
        marks.append((i, 0, int(i % 4 == 0)))
    rows += [(1000, None, "xx", "s", 1), (1001, "", None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["op3_toxic_crf"].build(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert area(np.array([int(r.doc_id % 4 == 0) for r in held]), np.array([r.score for r in held])) > 0.97


def test_op4(spark, sf):
    got = QUERIES["op4_phrase_automata"].build(spark, sf).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_phrases([r[:2] for r in ROWS], 13)


def test_op5(spark, sf):
    got = QUERIES["op5_ring_shards"].build(spark, sf).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    sizes = Counter(r.shard for r in got)
    assert set(sizes) <= set(range(8)) and max(sizes.values()) - min(sizes[s] for s in range(8)) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in sizes.items())
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_op6(spark, sf):
    own = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in ROWS:
        ids = np.array([*own.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        want[r[0], ids.size] += 1
    pieces = QUERIES["op6_window_pack"].build(spark, sf).collect()
    assert Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0) == want
    assert sum(p.length for p in pieces) == sum(n * k for (_, n), k in want.items())
    assert all(p.offset + p.length <= 1024 for p in pieces)


def test_op8(spark, sf):
    got = QUERIES["op8_piece_counts"].build(spark, sf).collect()
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((r[0], len((r[1] or "").encode().split())) for r in ROWS)
    assert all(r.n_tokens >= r.n_words for r in got)


def test_op10(spark, sf):
    prints = [(r[0], brute_print(r[1], 4)) for r in ROWS]
    groups, least = brute_components({p for _, p in prints}, 4), {}
    for i, p in prints:
        if i is not None:
            least[groups[p]] = min(i, least.get(groups[p], i))
    got = QUERIES["op10_golay_simhash"].build(spark, sf).collect()
    assert Counter(map(tuple, got)) == Counter((i, f"{p:016x}", least.get(groups[p])) for i, p in prints)
