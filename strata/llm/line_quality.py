"""Quality rules by cross-document line frequency, in DataFrame operations only.

Lines are normalised (A-Z lower-cased, blank runs to one space, trimmed) and
hashed. Per host, documents are counted by a digest of the whole text, so exact
copies of a document count once. A line is above the limits when it stands in
more than ``max(min_docs, share * distinct documents of the host)`` distinct
documents, however many copies some of them have. Such lines are removed, and a document is
rejected when less than ``min_left`` of its words remain, or when a base rule
fails.

Null and empty texts have no words and fail the base rule. A null host is a
host of its own. Repeated rows are judged alike. Very long texts and lines are
taken whole. An empty table gives no rows. ``clean`` keeps all columns, of any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import BLANK_CLASS, ROW, as_row, ascii_lower, row_columns, text_digest, written

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MIN_DOCS = 10
SHARE = 0.002
MIN_LEFT = 0.3
BROADCAST_LINES = 200_000  # above this many frequent lines the documents are joined by id instead


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANK_CLASS}]+"), "")


def lines_of(text: Column) -> Column:
    """The \\n-split lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(f"[^{BLANK_CLASS}]"))


def normal_line(line: Column) -> Column:
    return ascii_lower(F.trim(F.regexp_replace(line, f"[{BLANK_CLASS}]+", " ")))


def with_base(docs: DataFrame, text_col: str) -> DataFrame:
    """Replaces the text by the base columns n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.col("_lines")
    step = (
        docs.withColumn("_words", words_of(text)).withColumn("_lines", lines_of(text))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"))
        .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
        .withColumn("n_words", F.size("_words").cast("long"))
        .drop(text_col, "_lines")
        .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .drop("_words")
        .withColumn(
            "_windows",
            F.when(
                F.col("n_words") >= WINDOW,
                F.transform(
                    F.sequence(F.lit(1), F.col("n_words").cast("int") - (WINDOW - 1)),
                    lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW)),
                ),
            ).otherwise(F.expr("array(0L)")),
        )
        .drop("_hashes")
        # Only texts in which some window comes back need their windows sorted.
        .withColumn("_again", F.size(F.array_distinct("_windows")) < F.size("_windows"))
        .withColumn(
            "_sorted",
            F.when(F.col("_again"), F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
        )
        .withColumn(
            "_at",
            F.array_sort(F.transform(
                F.filter(
                    "_sorted",
                    lambda e, j: F.coalesce(F.get("_sorted", j - 1)["h"] == e["h"], F.lit(False))
                    | F.coalesce(F.get("_sorted", j + 1)["h"] == e["h"], F.lit(False)),
                ),
                lambda e: e["i"],
            )),
        )
        .withColumn(
            "n_repeat_words",
            F.when(
                F.col("_again"),
                F.aggregate(
                    F.transform("_at", lambda p, j: F.least(F.coalesce(F.get("_at", j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
                    F.lit(0).cast("long"), lambda a, x: a + x,
                ),
            ).otherwise(F.lit(0).cast("long")),
        )
        .drop("_windows", "_again", "_sorted", "_at")
    )
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return step.withColumn("base_failed", failed)


def frequent_lines(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE
) -> DataFrame:
    """(_host, _line): hashes of the lines above the limits, by host."""
    host = F.col(host_col).cast("string")
    rows = docs.select(host.alias("_host"), F.col(text_col).alias("_text"))
    seen = (
        rows.select(
            "_host", text_digest(F.col("_text")).alias("_doc"),
            F.explode(F.array_distinct(F.transform(lines_of(F.col("_text")), lambda x: F.xxhash64(normal_line(x))))).alias("_line"),
        )
        # distinct documents first: a line or copy that fills a third of the rows is one row per task here
        .distinct()
        .groupBy("_host", "_line").agg(F.count("*").alias("_docs"))
        .filter(F.col("_docs") > min_docs)
    )
    # copies of a document count once here too, else they would lift the limit for all other lines
    hosts = rows.select("_host", text_digest(F.col("_text")).alias("_doc")).distinct()
    hosts = hosts.groupBy("_host").agg(F.count("*").alias("_all"))
    over = seen.join(hosts.withColumnRenamed("_host", "_h"), F.col("_host").eqNullSafe(F.col("_h")))
    return over.filter(F.col("_docs") > F.lit(share) * F.col("_all")).select("_host", "_line")


def removed_lines(
    docs: DataFrame, frequent: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """(_id, _digest, _host, _removed words, _lines) of the documents that hold
    frequent lines; one row for each id, host and text."""
    host = F.col(host_col).cast("string")
    held = docs.select(F.col(id_col).alias("_id"), host.alias("_host"), F.col(text_col).alias("_text"))
    held = held.select(
        "_id", "_host", text_digest(F.col("_text")).alias("_digest"),
        F.posexplode(lines_of(F.col("_text"))).alias("_at", "_x"),
    )
    held = held.select(
        "_id", "_host", "_digest", "_at", F.size(words_of(F.col("_x"))).alias("_n"),
        F.xxhash64(normal_line(F.col("_x"))).alias("_line"),
    )
    over = frequent.select(F.col("_host").alias("_h"), F.col("_line").alias("_l"))
    return (
        held.join(over, F.col("_host").eqNullSafe(F.col("_h")) & (F.col("_line") == F.col("_l")))
        # a repeated row holds the same line at the same place: one row of it counts
        .groupBy("_id", "_host", "_digest", "_at").agg(F.max("_n").alias("_n"), F.max("_line").alias("_line"))
        .groupBy("_id", "_host", "_digest")
        .agg(F.sum("_n").alias("_removed"), F.collect_set("_line").alias("_bad"))
    )


def _join_removed(rows: DataFrame, removed: DataFrame, id_col: str, host_col: str) -> DataFrame:
    r = removed.select(*[F.col(c).alias(f"_r{c}") for c in removed.columns])
    on = (
        F.col(id_col).eqNullSafe(F.col("_r_id")) & F.col(host_col).cast("string").eqNullSafe(F.col("_r_host"))
        & (F.col("_digest") == F.col("_r_digest"))
    )
    return rows.join(r, on, "left")


def line_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_docs: int = MIN_DOCS, share: float = SHARE, min_left: float = MIN_LEFT,
) -> tuple[DataFrame, DataFrame]:
    """(verdicts, removed): verdicts has one row per row of ``docs`` with the
    id, the base columns, base_failed, n_removed_words and kept; ``removed`` is
    what ``removed_lines`` gives, for ``clean``."""
    frequent = written(frequent_lines(docs, text_col, host_col, min_docs, share), "frequent-lines")
    removed = written(removed_lines(docs, frequent, id_col, text_col, host_col), "removed-lines")
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(host_col).alias("_host"), text.alias("_judged"), text_digest(text).alias("_digest")
    )
    joined = _join_removed(with_base(rows, "_judged"), removed, "_id", "_host")
    gone = F.coalesce(F.col("_r_removed"), F.lit(0)).cast("long")
    depleted = (F.col("n_words") - gone) < F.lit(min_left) * F.col("n_words")
    verdicts = joined.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~depleted).alias("kept"), gone.alias("n_removed_words"),
    )
    return verdicts, removed


def clean(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_docs: int = MIN_DOCS, share: float = SHARE, min_left: float = MIN_LEFT,
) -> DataFrame:
    """``docs`` without its rejected documents and without the lines above the
    limits; all columns stay (a text without such lines is left byte for byte)."""
    frequent = written(frequent_lines(docs, text_col, host_col, min_docs, share), "frequent-lines")
    text = F.col(text_col)
    rows = as_row(
        docs, F.col(id_col).alias("_id"), F.col(host_col).cast("string").alias("_host"), text.alias("_judged"),
        text_digest(text).alias("_digest"),
    )
    # The always true second term is not deterministic for Spark, which keeps the
    # filter above the projections: pushed below them it would take the base
    # expressions along, one inside the other's lambda.
    passed = ~F.col("base_failed") & (F.monotonically_increasing_id() >= 0)
    based = with_base(rows, "_judged").withColumn("_passed", passed).filter("_passed")
    if frequent.count() <= BROADCAST_LINES:
        # A line counts only if a share of its host's documents hold it, so a host has few;
        # with each host's list at hand no text is shuffled.
        lists = frequent.groupBy(F.col("_host").alias("_r_host")).agg(F.collect_set("_line").alias("_r_bad"))
        joined = based.join(F.broadcast(lists), F.col("_host").eqNullSafe(F.col("_r_host")), "left")
    else:
        joined = _join_removed(based, written(removed_lines(docs, frequent, id_col, text_col, host_col), "removed-lines"),
                               "_id", "_host")
    bad, own = F.col("_r_bad"), F.col(ROW)[text_col]
    lines = F.split(own, "\n")
    over = F.transform(lines, lambda x: F.array_contains(bad, F.xxhash64(normal_line(x))))
    marked = joined.withColumn("_over", F.when(bad.isNotNull(), over))  # each line is normalised once
    gone = F.aggregate(
        F.filter(lines, lambda x, i: F.get("_over", i)), F.lit(0).cast("long"),
        lambda n, x: n + F.size(words_of(x)).cast("long"),
    )
    touched = F.coalesce(F.exists("_over", lambda x: x), F.lit(False))
    enough = ~touched | ((F.col("n_words") - gone) >= F.lit(min_left) * F.col("n_words"))
    left = marked.withColumn("_enough", enough & (F.monotonically_increasing_id() >= 0)).filter("_enough")
    kept = F.filter(lines, lambda x, i: ~F.get("_over", i))
    return left.select(*row_columns(docs, **{text_col: F.when(touched, F.array_join(kept, "\n")).otherwise(own)}))
