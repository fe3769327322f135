"""URL filter: host/path rules, then a list of canonical URLs.

Listed canonical URLs set bits in a blocked Bloom filter (256-bit blocks, one
64-bit word per probe), sized from the counted list: ``BITS`` bits an entry,
which lets about one page in 300 through that is not listed. Up to
``BROADCAST_BLOCKS`` blocks (some 60 MB, 16 million entries) the filter is
broadcast; a larger one meets the pages by block number. An exact hash join on
the canonical URL removes the false positives of either.

Null or malformed URLs have empty host and path, fit no rule and are never
listed. Very long URLs are hashed whole. Repeated rows are judged alike; an
empty list blocks nothing; an empty table of pages gives no rows. Columns of
``pages`` other than the ids and the URL are not kept, so their names clash
with none of the result's.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, written

URL_PATTERN = "(?s)^.*?://([^/?#]*)([^?#]*)"
WORDS = 4
BITS = 16  # of the filter for each listed URL
BROADCAST_BLOCKS = 1 << 20


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL_PATTERN, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, URL_PATTERN, 2), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without ``www.``/``m.``, path without its trailing slash or
    ``.html``, query without tracking parameters, no scheme, no fragment.
    Null where the URL has no host."""
    host = F.regexp_replace(host_of(url), "^(www|m)\\.", "")
    path = F.regexp_replace(path_of(url), "(/|\\.html)$", "")
    query = F.regexp_extract(url, "(?s)^[^?#]*\\?([^#]*)", 1)
    kept = F.array_join(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref)=")), "&"
    )
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule whose host is the URL's host
    or a parent domain of it and whose path begins the URL's path; else null.
    ``rules``: (host, path, verdict)."""
    chain = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        chain = F.when(fits, found).otherwise(chain)
    return chain


def _block(canonical: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(canonical), F.lit(blocks)).cast("int")


def _bits(canonical: Column) -> list[Column]:
    """One bit for each word of the block, from six bits each of a second hash."""
    second = F.xxhash64(canonical, F.lit("bloom"))
    return [
        F.call_function(
            "shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(second, 6 * w).bitwiseAND(F.lit(63)).cast("int")
        )
        for w in range(WORDS)
    ]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3) for each block that the canonical URLs of ``listed`` touch."""
    canonical = F.col("canonical")
    rows = listed.select(_block(canonical, blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(canonical))])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    url_col: str = "url",
    listed_col: str = "url",
    id_cols: Sequence[str] = ("page_id",),
    broadcast_blocks: int = BROADCAST_BLOCKS,
) -> DataFrame:
    """Judge every URL of ``pages``.

    A fitting rule decides; otherwise a URL whose canonical form is in
    ``listed`` is blocked and any other is allowed. Returns the id columns,
    host, path, rule, verdict, canonical and is_listed (one row per row).
    A filter of more than ``broadcast_blocks`` blocks of 32 bytes is not broadcast.
    """
    url = F.col(url_col)
    entries = listed.select(canonical_url(F.col(listed_col)).alias("canonical"))
    entries = written(entries.filter(F.col("canonical").isNotNull()).distinct(), "listed-urls")
    blocks = max(1, entries.count() * BITS // 256)
    judged = pages.select(
        *id_cols, host_of(url).alias("host"), path_of(url).alias("path"), canonical_url(url).alias("canonical")
    ).withColumn("_rule", match_rule(F.col("host"), F.col("path"), rules))
    bloom = bloom_blocks(entries, blocks)  # at most ``blocks`` rows of five numbers
    if blocks <= broadcast_blocks:
        bloom = F.broadcast(bloom)
    canonical = F.col("canonical")
    probed = judged.withColumn("block", _block(canonical, blocks)).join(bloom, "block", "left")
    possible = reduce(
        Column.__and__, [F.col(f"w{i}").bitwiseAND(bit) == bit for i, bit in enumerate(_bits(canonical))]
    )
    probed = probed.select(
        *id_cols, "host", "path", "canonical", "_rule",
        F.coalesce(canonical.isNotNull() & possible, F.lit(False)).alias("_possible"),
    )
    missed = probed.filter(~F.col("_possible")).withColumn("is_listed", F.lit(False))
    exact = entries.withColumn("_listed", F.lit(True))
    hits = (
        probed.filter("_possible").join(exact, "canonical", "left")
        .withColumn("is_listed", F.coalesce("_listed", F.lit(False))).drop("_listed")
    )
    own = F.when(F.col("is_listed"), F.lit("block")).otherwise("allow")
    return missed.unionByName(hits).select(
        *id_cols, "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), own).alias("verdict"), "canonical", "is_listed",
    )
