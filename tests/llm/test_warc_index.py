"""WARC files: exact round trips, the index, range reads and damaged files."""

import gzip
import hashlib
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import warc_index

SCHEMA = "page_id long, url string, html string, path string, offset int, id string, digest string, size int"


def messy_pages():
    rng = random.Random(11)
    long = "<p>é" + "x" * 1200 + "</p>"
    htmls = [long] * 40 + ["<b>short</b>"] * 5 + [None, "", "\r\n\r\n", "WARC/1.1\r\n\r\n", "ü" * 500, "ü" * 499, "a" * 999, "a" * 999, "a" * 1000, "a" * 1000]
    htmls += ["".join(rng.choice("abc<>/ \n☃") for _ in range(n)) for n in (10, 1500, 3000, 400_000)]
    urls = ["http://a.b/c?d=e f\r\nX: y", None, "http://é.example/ü", "", "no scheme"]
    rows = [(i, urls[i % 5], h) for i, h in enumerate(htmls)]
    rows += [(None, "http://n/", long), (None, None, "only" * 400), (None, None, "only" * 400), rows[39], rows[46]]
    rng.shuffle(rows)
    return [(*r, "p", 1, "i", "d", 2) for r in rows]


ROWS = messy_pages()


def wanted(rows):
    newest = defaultdict(lambda: -1)
    for i, _, h, *_ in rows:
        if i is not None:
            newest[h or ""] = max(newest[h or ""], i)
    out = []
    for i, _, h, *_ in rows:
        raw, top = (h or "").encode(), newest[h or ""]
        again = len(raw) >= 1000 and top >= 0 and (i is None or i < top)
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    index = warc_index.write_archives(pages, root=str(tmp_path / "w"), file_bytes=20_000, date="2020-01-02T03:04:05Z")
    records = warc_index.read_records(index, gap=64, span=50_000).cache()
    got = [(r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records.collect()]
    assert sorted(got, key=str) == wanted(ROWS)
    whole = warc_index.with_payloads(records).collect()
    assert sorted((str(r.id), bytes(r.payload)) for r in whole) == sorted((str(r[0]), (r[2] or "").encode()) for r in ROWS)
    assert sorted(map(str, (r.url for r in index.collect()))) == sorted(str(r[1]) for r in ROWS)
    # the files are gzip as such, every member a record, in the order of the index
    named = defaultdict(list)
    for r in index.collect():
        named[r.path].append((r.offset, r.length))
    files = [f for f in os.listdir(tmp_path / "w") if not f.endswith(".crc")]
    assert len(files) == len(named) > 3
    for path, places in named.items():
        text = gzip.open(path).read()
        assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(places) + 1  # and the warcinfo
        end = max(o + n for o, n in places)
        assert end == os.path.getsize(path)
        places.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(places, places[1:]))


def test_selected_records_only(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    index = warc_index.write_archives(pages)
    some = index.filter("id % 7 = 3")
    got = warc_index.read_records(some).collect()
    want = [(r[0], (r[2] or "").encode()) for r in ROWS if r[0] is not None and r[0] % 7 == 3]
    assert sorted((r.id, None if r.payload is None else bytes(r.payload)) for r in got if r.record_type == "response") == sorted(
        w for w in want if (w[0], "response") in {(r.id, r.record_type) for r in got})
    assert len(got) == len(want)
    twice = some.union(some)
    assert warc_index.read_records(twice, payload=False).count() == 2 * len(want)
    assert warc_index.read_records(index.filter("false")).count() == 0


def test_empty_table(spark):
    index = warc_index.write_archives(spark.createDataFrame([], SCHEMA))
    assert index.count() == 0 and warc_index.read_records(index).count() == 0


def test_repeats_by_a_shuffled_join(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        records = warc_index.read_records(warc_index.write_archives(pages), payload=False).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records), key=str) == wanted(ROWS)


def test_text_ids_and_damage(spark, tmp_path):
    pages = spark.createDataFrame([("a b\n%", "http://x/", "p" * 1500), ("ü", "http://y/", "p" * 1500)], "k string, u string, t string")
    index = warc_index.write_archives(pages.coalesce(1), "k", "u", "t", root=f"file://{tmp_path}/d")
    got = {r.id: (r.record_type, r.refers_to) for r in warc_index.read_records(index).collect()}
    assert got == {"a b\n%": ("revisit", "ü"), "ü": ("response", None)}
    raw = warc_index.packed(warc_index.warc_record("response", [("WARC-Payload-Digest", "sha1:" + "A" * 32)], b"HTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\nx"))
    (tmp_path / "bad").write_bytes(raw)
    bad = spark.createDataFrame([("x", str(tmp_path / "bad"), 0, len(raw))], "id string, path string, offset long, length long")
    with pytest.raises(Exception, match="payload does not have its digest"):
        warc_index.read_records(bad.withColumn("url", F.lit(None))).collect()


def test_joined_ranges():
    places = [("a", 0, 10), ("a", 10, 5), ("a", 30, 5), ("a", 200, 5), ("a", 200, 5), ("b", 0, 500)]
    got = list(warc_index.joined_ranges(iter(places), gap=20, span=60))
    assert got == [("a", 0, [(0, 10), (10, 5), (30, 5)]), ("a", 200, [(200, 5), (200, 5)]), ("b", 0, [(0, 500)])]
    assert [len(h) for _, _, h in warc_index.joined_ranges(iter(places), gap=1000, span=14)] == [1, 1, 1, 2, 1]
