"""Registered queries of the training-data operators over the driver's tables.

Each query is a thin digest over its operator; ``oracle`` holds SQL where SQL
can express the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    brown_lm, common, cover_codes, decontaminate, line_quality, phrase_dedup, piece_counts, recompress, ring_shard, simhash,
    toxic_crf, url_filter, warc_index, window_pack,
)
from strata.plans.registry import Registered, table

QUERIES: dict[str, Registered] = {}


def query(name: str, oracle: str | None = None):
    def wrap(build):
        QUERIES[name] = Registered(name, build, oracle, (name.split("_")[0],))
        return build

    return wrap


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op5_ring_shards")
def op5_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 8 shards, counts at most one apart (law ``rows``)."""
    text = F.coalesce("text", F.lit(""))
    narrow = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return ring_shard.ring_shards(narrow, ["doc_id"], shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op6_window_pack")
def op6_window_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    import public_tokenizers

    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    return window_pack.pack(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


@query("op8_piece_counts")
def op8_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of all documents."""
    pieces = piece_counts.model_pieces(tokenizer_path("piece_bpe_32k.model"))
    return piece_counts.count_pieces(table(spark, sf_dir, "documents"), pieces)


# The rules that the contract fixes: (host, path, verdict).
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# A page whose title is strewn with junk symbols puts its URL on the list.
JUNK_TITLE = "<title>[^<]*(%%%|\\*\\*\\*|###|\\$\\$\\$)[^<]*</title>"


def _url_oracle() -> str:
    url = "coalesce(url, '')"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = lower.format(f"regexp_extract({url}, '{url_filter.URL_PATTERN}', 1)")
    path = f"regexp_extract({url}, '{url_filter.URL_PATTERN}', 2)"
    cases = []
    for rule_host, rule_path, verdict in sorted(URL_RULES, key=lambda r: -len(r[0] + r[1])):
        cases.append(
            f"WHEN (host = '{rule_host}' OR ends_with(host, '.{rule_host}')) AND starts_with(path, '{rule_path}')"
            f" THEN '{rule_host}{rule_path}|{verdict}'"
        )
    return f"""
WITH parsed AS (SELECT page_id, html, {host} AS host, {path} AS path,
    list_filter(string_split(regexp_extract({url}, '(?s)^[^?#]*\\?([^#]*)', 1), '&'),
                lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref)=')) AS params FROM pages),
canon AS (SELECT page_id, html, host, path,
    CASE WHEN host <> '' THEN concat(regexp_replace(host, '^(www|m)\\.', ''), regexp_replace(path, '(/|\\.html)$', ''),
         CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END) END AS canonical FROM parsed),
listed AS (SELECT DISTINCT canonical FROM canon
           WHERE regexp_matches(html, '{JUNK_TITLE}') AND canonical IS NOT NULL),
ruled AS (SELECT *, CASE {' '.join(cases)} END AS hit, canonical IN (SELECT canonical FROM listed) AS found FROM canon)
SELECT page_id, host, path, string_split(hit, '|')[1] AS rule,
       CASE WHEN hit IS NOT NULL THEN string_split(hit, '|')[2] WHEN found THEN 'block' ELSE 'allow' END AS verdict,
       canonical, coalesce(found, false) AS is_listed
FROM ruled"""


@query("op9_url_filter", _url_oracle())
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, then the list of canonical URLs of junk-titled pages."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.filter(F.col("html").rlike(JUNK_TITLE)).select("url")
    return url_filter.judge_urls(pages, listed, URL_RULES)


def _lines_oracle() -> str:
    blank = "[\\x20\\x09-\\x0D]"
    words = f"list_filter(regexp_split_to_array({{}}, '{blank}+'), lambda w: w <> '')"
    normal = (
        "translate(trim(regexp_replace(x, '" + blank + "+', ' ', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    return f"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
parts AS (SELECT *, {words.format('text')} AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM docs),
grams AS (SELECT r, i, array_to_string(words[i:i+4], ' ') AS g
          FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM parts WHERE len(words) >= 5)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(5)) AS k) GROUP BY r),
base AS (SELECT p.*, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '{line_quality.SYMBOLS}', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
    FROM parts p LEFT JOIN covered c USING (r)),
held AS (SELECT r, source, text, unnest(lines) AS x FROM base),
normal AS (SELECT r, source, text, {normal} AS line, len({words.format('x')}) AS n FROM held),
frequent AS (SELECT source, line FROM (
    SELECT source, line, count(DISTINCT text) AS d FROM normal GROUP BY ALL)
    JOIN (SELECT source, count(DISTINCT text) AS every FROM docs GROUP BY source) USING (source)
    WHERE d > {line_quality.MIN_DOCS} AND d > {line_quality.SHARE} * every),
gone AS (SELECT r, sum(n) AS n FROM normal JOIN frequent USING (source, line) GROUP BY r)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
    (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
        AND (n_words - coalesce(gone.n, 0)) >= {line_quality.MIN_LEFT} * n_words AS kept,
    coalesce(gone.n, 0)::BIGINT AS n_removed_words
FROM base LEFT JOIN gone USING (r)"""


@query("op7_line_quality", _lines_oracle())
def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, line frequency and verdict of every document; the source is the host."""
    return line_quality.line_quality(table(spark, sf_dir, "documents"))[0]


@query("op10_golay_simhash")
def op10_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, 4 differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select(
        F.col("id").alias("doc_id"), simhash.hex_print(F.col("print")).alias("fingerprint"), "component_id"
    )


_LEAKS_ORACLE = """
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words FROM documents),
items AS (SELECT item_id::VARCHAR AS item, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words FROM benchmark WHERE item_id IS NOT NULL),
cut AS (SELECT item, words, least(10, len(words)) AS n, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM items WHERE len(words) > 0),
wanted AS (SELECT DISTINCT item, n, array_to_string(words[i:i+n-1], ' ') AS g FROM cut),
sizes AS (SELECT DISTINCT n FROM wanted),
grams AS (SELECT r, n, i, array_to_string(words[i:i+n-1], ' ') AS g
          FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, sizes WHERE len(words) >= n)),
hits AS (SELECT r, item, i, n FROM grams JOIN wanted USING (n, g)),
covered AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS all_items
          FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
       sha256(coalesce(all_items, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""


@query("op2_prefix_decontaminate", _LEAKS_ORACLE)
def op2_prefix_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark found in each document, 10-word windows."""
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return found.select(
        F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
    )


@query("op3_toxic_crf")
def op3_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    learn = table(spark, sf_dir, "labels").filter(fold != 0).select("doc_id", "toxic")
    scored = toxic_crf.score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), learn)
    return scored.select(F.col("id").alias("doc_id"), "score", "spans").select(
        "doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans"
    )


@query("op4_phrase_automata")
def op4_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document in 13-word windows that start in an earlier one too."""
    found = phrase_dedup.repeated_phrases(table(spark, sf_dir, "documents").select("doc_id", "text"), window=13)
    return found.select(
        f"{common.ROW}.doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"),
        F.col("_kept").alias("kept_sha256"),
    )


@query("op1_brown_lm")
def op1_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document under a class bigram model of those not held out."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return brown_lm.score_corpus(table(spark, sf_dir, "documents"), held_out).withColumnRenamed("id", "doc_id")


def _codes_oracle(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Plain Lloyd rounds in long form: a row for each (vector, part, place in the part)."""
    steps = [f"""
WITH kept AS (SELECT row_number() OVER () AS r, vec_id, label, embedding,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (SELECT r, (i - 1) // (len(v) // {parts}) AS p, (i - 1) % (len(v) // {parts}) AS d, v[i] AS x
    FROM (SELECT r, v, unnest(range(1, len(v) + 1)) AS i FROM kept)),
first AS (SELECT r, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS e FROM kept WHERE vec_id IS NOT NULL
    QUALIFY e < {entries}),
book0 AS (SELECT p, e, d, x FROM cells JOIN first USING (r))"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS (SELECT r, p, min(gap)::BIGINT AS gap, arg_min(e, gap * {entries} + e) AS e FROM (
    SELECT r, p, e, sum((c.x - b.x) * (c.x - b.x)) AS gap FROM cells c JOIN book{k} b USING (p, d) GROUP BY r, p, e)
    GROUP BY r, p)""")
        if k < rounds:
            steps.append(f"""book{k + 1} AS (SELECT b.p, b.e, b.d, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
    SELECT p, e, d, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x FROM near{k} JOIN cells USING (r, p) GROUP BY p, e, d) m
    USING (p, e, d))""")
    steps.append(f"""coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(gap)::BIGINT AS error
    FROM near{rounds} GROUP BY r),
books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, d)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books""")
    return ",\n".join(steps)


@query("op12_cover_codes", _codes_oracle())
def op12_cover_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16-byte codes of all vectors, 64 entries a part, two rounds."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    found, books = cover_codes.vector_codes(vectors, "vec_id", "embedding", parts=16, entries=64, rounds=2)
    numbers = ",".join(str(x) for book in books for entry in book for x in entry)
    coded = common.written(found.select(f"{common.ROW}.*", "code", "error"), "vector-codes")
    of_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error",
        F.sha2(F.lit(numbers).cast("binary"), 256).alias("codebooks_sha256"),
    )


_ARCHIVE_ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT *, strlen(html) AS size, max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, size::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
    CASE WHEN size >= 1000 AND page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN size >= 1000 AND page_id < newest THEN newest END AS refers_to
FROM q"""


@query("op13_warc_index", _ARCHIVE_ORACLE)
def op13_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages to WARC files, and every record read back by the index."""
    index = warc_index.write_archives(table(spark, sf_dir, "pages"), "page_id", "url", "html", revisit_from=1000)
    return warc_index.read_records(index, payload=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def _with_planted_period(docs: DataFrame) -> DataFrame:
    """The contract's texts: where crc32(doc_id) % 10 is 0, words from a on repeat with period p."""
    g = F.expr("_h div 10")
    words = F.when(F.col("_h") % 10 == 0, F.filter(F.split("text", f"[{common.BLANK_CLASS}]+"), lambda w: w != ""))
    cut = docs.withColumn("_h", F.crc32(F.col("doc_id").cast("string"))).withColumn("_words", words)
    cut = cut.withColumn("_n", F.size("_words").cast("long")).withColumn("_a", F.when(F.col("_n") > 0, g % F.col("_n")))
    cut = cut.withColumn("_p", F.expr("1 + (_n - _a) div (3 + (_h div 10) % 8)"))
    tail = F.expr("slice(flatten(array_repeat(slice(_words, int(_a + 1), int(_p)), int((_n - _a) div _p + 1))), 1, int(_n - _a))")
    planted = F.array_join(F.concat(F.expr("slice(_words, 1, int(_a))"), tail), " ")
    return cut.select("doc_id", F.coalesce(planted, F.col("text")).alias("text"))


@query("op11_recompression_runs")
def op11_recompression_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all documents' words, and the texts without their repeats."""
    docs = _with_planted_period(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = recompress.find_runs(docs, exponent=4, least=6)
    # the greatest length; then the smallest start, then period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(f"{common.ROW}.doc_id", "runs", "collapsed", longest.alias("best"), lines.alias("lines")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.col3")).alias("period"),
        F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
