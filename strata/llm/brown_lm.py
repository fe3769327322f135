"""Brown class-based bigram language model.

Counting. Every training word is counted over the whole corpus. Words at or
above a count that at most ``head`` words reach are the head, whose counts are
broadcast (a bounded table, always with the end); the others are met by a join, so the vocabulary
itself may be of any size.

Classes. Exchange clustering of the ``core`` most frequent words: sweep by
sweep each word moves to the class that raises the mutual information of
neighbouring classes most, with all words outside the core as one class of
their own. The next words up to ``clustered``, and all others that stand
``least`` times or oftener, then go in one exchange step to the class that best
predicts them from the classes before them: these counts are grouped by word
over the corpus and never gathered. Rarer words and unseen ones share the last
class. The driver holds the head and tables by class only.

Coding. One more pass over the texts writes each as a string of classes, a byte
a word, with the sum of the logs of its words' counts; neighbours with a word
outside the head are rows of their own, met with the tail's counts and classes
by joins. Both what the classes' links are counted from and what is scored are
these tables: no text is split again.

Score. P(w | v) = weight * P(class w | class v) * P(w | class w)
+ (1 - weight) * P(w); classes follow each other with counts smoothed towards
their shares, words with one added to their counts, unseen words together
counting as one more word. It is a distribution over the known words and
"unseen". A text's score is log10 of the product over its words and an end.

Null and empty texts are the end alone; repeated rows are scored alike and
learned from as often as they stand; without training rows every word is unseen.
Very long texts are taken whole; an empty table gives no rows; other columns are
not kept, so their names clash with none of the result's.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import encoded, ship_by_value, slices, written

ship_by_value(__name__)

END = b"\n"  # no word holds a blank
CLASSES = 48
CORE = 1500
CLUSTERED = 20_000
LEAST = 5  # count from which every word has a class of its own choice
HEAD = 200_000
WEIGHT = 0.9
TAIL = 255  # stands for the class of a word outside the head
PRIOR = 20.0
HELD = 200_000  # words whose counts a task gathers before it hands them on


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def _batches(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in slices(batches, column, 2 << 20):
        yield batch, encoded(batch.column(batch.schema.names.index(column)))


def _flat(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts in turn, the end after each, and how many each text has."""
    out: list[bytes] = []
    size = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        n = len(out)
        out += words_of(text)
        out.append(END)
        size[i] = len(out) - n
    return out, size


def _numbers(words: list[bytes], number: dict[bytes, int], other: int) -> np.ndarray:
    return np.fromiter(map(number.get, words, repeat(other)), np.int64, len(words))


def _before(numbers: np.ndarray, first: int) -> np.ndarray:
    """The number before each; before a text's first word stands an end."""
    return np.concatenate(([first], numbers[:-1]))


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) over the text column of ``rows``, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )

        counts: Counter = Counter()
        for _, texts in _batches(batches):
            for text in texts:
                counts.update(words_of(text))
                counts[END] += 1
                if len(counts) > HELD:
                    yield out(counts)
                    counts = Counter()
        yield out(counts)

    return rows.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _pair_counts(
    rows: DataFrame, shared: Broadcast, pairs: Callable[[np.ndarray, object], tuple[np.ndarray, np.ndarray]]
) -> DataFrame:
    """(pair, n): the pair numbers that ``pairs`` makes of word numbers, counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, other, extra = shared.value
        kept, n_kept = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def folded() -> tuple[np.ndarray, np.ndarray]:
            value, at = np.unique(np.concatenate(kept), return_inverse=True)
            return value, np.bincount(at, np.concatenate(n_kept), value.size).astype(np.int64)

        for _, texts in _batches(batches):
            value, n = np.unique(pairs(_numbers(_flat(texts)[0], number, other), extra), return_counts=True)
            kept.append(value)
            n_kept.append(n)
            if sum(x.size for x in kept) > 4_000_000:
                value, n = folded()
                kept, n_kept = [value], [n]
                if value.size > 2_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n)], names=["pair", "n"])
                    kept, n_kept = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        value, n = folded()
        yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n)], names=["pair", "n"])

    return rows.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _gathered(pair_counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, after, n) of a bounded table of pair counts, as plain arrays."""
    table = pair_counts.toArrow()
    pair = table["pair"].to_numpy()
    return pair >> 32, pair & 0xFFFFFFFF, table["n"].to_numpy()


def _context_counts(rows: DataFrame, shared: Broadcast) -> DataFrame:
    """(number, word, before, n): each word outside the core by the core class
    before it (the last class for words outside), counted. Head words have their
    number, others their word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, class_of, core, size = shared.value  # head words in order; class of each core word and of all others
        number = {w: i for i, w in enumerate(words)}
        rare = len(words)
        end = number.get(END, rare)
        table = np.zeros((rare - core) * size, np.int32)  # bounded by the head's size
        tail: Counter = Counter()

        def out(numbers: pa.Array, tails: pa.Array, before: list | np.ndarray, n: list | np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [numbers, tails, pa.array(before, pa.int32()), pa.array(n, pa.int64())], names=["number", "word", "before", "n"])

        def out_tail() -> pa.RecordBatch:
            keys = list(tail)
            return out(pa.nulls(len(keys), pa.int32()), pa.array([w for w, _ in keys], pa.binary()), [c for _, c in keys],
                       list(tail.values()))

        for _, texts in _batches(batches):
            flat, _ = _flat(texts)
            numbers = _numbers(flat, number, rare)
            before = class_of[np.minimum(_before(numbers, end), core)]
            known = (numbers >= core) & (numbers < rare)
            value, n = np.unique((numbers[known] - core) * size + before[known], return_counts=True)
            table[value] += n.astype(np.int32)
            at = np.nonzero(numbers == rare)[0]
            tail.update(zip([flat[i] for i in at.tolist()], before[at].tolist()))
            if len(tail) > HELD:
                yield out_tail()
                tail = Counter()
        yield out_tail()
        found = np.nonzero(table)[0]
        for i in range(0, found.size, 1 << 18):
            at = found[i : i + (1 << 18)]
            yield out(pa.array((at // size + core).astype(np.int32)), pa.nulls(at.size, pa.binary()), (at % size).astype(np.int32),
                      table[at].astype(np.int64))

    made = rows.mapInArrow(run, "number int, word binary, before int, n long")
    return made.groupBy("number", "word", "before").agg(F.sum("n").alias("n"))


def _word_classes(contexts: DataFrame, shared: Broadcast) -> DataFrame:
    """(number, word, n, class): each word's count, and the class in which its contexts gain most."""
    by_word = contexts.groupBy("number", "word").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("before", "n")).alias("seen"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value  # by class before and class
        for batch in batches:
            seen = np.zeros((batch.num_rows, logs.shape[0]))
            at = np.repeat(np.arange(batch.num_rows), batch.column(3).value_lengths().to_numpy())
            before, n = batch.column(3).flatten().flatten()
            seen[at, before.to_numpy()] = n.to_numpy()
            best = np.argmax((seen @ logs)[:, :-1], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(best.astype(np.int32))], names=["number", "word", "n", "class"])

    return by_word.mapInArrow(run, "number int, word binary, n long, class int")


def _class_of_tail(pairs: DataFrame, tail: DataFrame, side: str, other: int) -> DataFrame:
    """``pairs`` with the class (and count) of the words on a side that stand
    outside the head; rows without such a word do not meet the join."""
    named, rest = pairs.filter(f"{side}_word is not null"), pairs.filter(f"{side}_word is null")
    found = tail.select(F.col("word").alias("_word"), F.col("n").alias("_n"), F.col("class").alias("_class"))
    joined = named.join(found, F.col(f"{side}_word") == F.col("_word"), "left")
    joined = joined.withColumn(side, F.coalesce("_class", F.lit(other))).withColumn(f"{side}_count", F.coalesce("_n", F.lit(0)))
    return joined.drop("_word", "_n", "_class", f"{side}_word").unionByName(
        rest.withColumn(f"{side}_count", F.lit(None).cast("long")).drop(f"{side}_word")
    )


def _tail_pairs(
    flat: list[bytes], numbers: np.ndarray, cls: np.ndarray, rare: int, end: int
) -> tuple[np.ndarray, list[pa.Array]]:
    """Places of the neighbours of which one or both stand outside the head, and
    their class and word before, class and word after: a word only where outside."""
    before = _before(numbers, end)
    at = np.nonzero((numbers == rare) | (before == rare))[0]
    columns = []
    for own, shift in ((before[at], 1), (numbers[at], 0)):
        outside = own == rare
        words = [flat[i] if out else None for i, out in zip((at - shift).tolist(), outside.tolist())]
        columns += [pa.array(cls[own].astype(np.int32), mask=outside), pa.array(words, pa.binary())]
    return at, columns


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange_classes(pairs: np.ndarray, classes: int, sweeps: int = 12) -> np.ndarray:
    """Class of each word of ``pairs`` (counts of word before word; the last row
    and column stand for all other words and keep the class ``classes``)."""
    m = pairs.shape[0] - 1
    k = classes + 1
    cls = np.append(np.arange(m) % classes, classes)
    hot = np.zeros((m + 1, k))
    hot[np.arange(m + 1), cls] = 1
    to_class, from_class = pairs @ hot, hot.T @ pairs  # words by next class, previous class by words
    table = hot.T @ to_class
    for _ in range(sweeps):
        moved = 0
        for w in range(m):
            a, self_pair = cls[w], pairs[w, w]
            right, left = to_class[w].copy(), from_class[:, w].copy()
            right[a] -= self_pair
            left[a] -= self_pair
            rest = table.copy()
            rest[a, :] -= right
            rest[:, a] -= left
            rest[a, a] -= self_pair
            rows, columns = rest.sum(axis=1), rest.sum(axis=0)
            before = _xlogx(rest)
            gain_row, gain_column = _xlogx(rest + right) - before, _xlogx(rest + left[:, None]) - before
            gain = gain_row.sum(axis=1) - np.diag(gain_row) + gain_column.sum(axis=0) - np.diag(gain_column)
            corner = np.diag(rest)
            gain += _xlogx(corner + right + left + self_pair) - _xlogx(corner)
            out_w, in_w = right.sum() + self_pair, left.sum() + self_pair
            gain -= _xlogx(rows + out_w) - _xlogx(rows) + _xlogx(columns + in_w) - _xlogx(columns)
            b = int(np.argmax(gain[:classes]))
            if gain[b] > gain[a] + 1e-9:
                to_class[:, a] -= pairs[:, w]
                to_class[:, b] += pairs[:, w]
                from_class[a] -= pairs[w]
                from_class[b] += pairs[w]
                cls[w] = b
                rest[b, :] += right
                rest[:, b] += left
                rest[b, b] += self_pair
                table = rest
                moved += 1
        if not moved:
            break
    return cls


@dataclass
class Vocabulary:
    """The head: word -> (count, class), the end always among them; how many tokens
    and words all training texts have; tokens and words of each class, of which the
    last is for words without a class."""

    head: dict[bytes, tuple[int, int]]
    total: int
    size: int
    tokens_in: np.ndarray
    words_in: np.ndarray

    @property
    def other(self) -> int:
        return self.words_in.size - 1

    @property
    def has_tail(self) -> bool:
        return self.size > len(self.head)


class BrownModel:
    """A vocabulary and the logs that scoring adds up."""

    def __init__(self, words: Vocabulary, links: np.ndarray, weight: float) -> None:
        self.head, self.total, self.other = words.head, words.total, words.other
        share = (words.tokens_in + 1e-9) / (words.tokens_in.sum() + 1e-9 * words.tokens_in.size)
        follow = (links + PRIOR * share) / (links.sum(axis=1, keepdims=True) + PRIOR)
        size = words.tokens_in + words.words_in
        size[self.other] += 1  # the unseen word
        self.uniform = 1 / (words.total + words.size + 1)
        # log10 of what a word's count plus one is multiplied by, by class before and own class
        self.link = np.log10(weight * follow / np.maximum(size, 1) + (1 - weight) * self.uniform)


def vocabulary(
    rows: DataFrame, classes: int = CLASSES, core: int = CORE, clustered: int = CLUSTERED, head: int = HEAD, least: int = LEAST,
) -> tuple[Vocabulary, DataFrame]:
    """The counted and clustered words of the text column of ``rows``, and those
    outside the head as a table (word, n, class)."""
    if classes >= TAIL:
        raise ValueError(f"at most {TAIL - 1} classes")
    spark = rows.sparkSession
    counts = written(word_counts(rows), "word-counts")
    # How many words have each count: a small table, from which the head's least count follows.
    levels = sorted(map(tuple, counts.groupBy("n").agg(F.count("*")).collect()), reverse=True)
    total, distinct = sum(n * k for n, k in levels), sum(k for _, k in levels)
    lowest, held = math.inf, 0
    for n, k in levels:
        if held + k > head:
            break
        lowest, held = n, held + k
    top: list[tuple[int, bytes]] = []
    if held:
        table = counts.filter(F.col("n") >= lowest).toArrow()
        top = sorted(zip(table["n"].to_pylist(), table["word"].to_pylist()), key=lambda x: (-x[0], x[1]))
    ends = counts.filter(F.col("word") == F.lit(END)).first()
    if ends and all(w != END for _, w in top):
        top.append((ends["n"], END))  # every text has an end: it is in the head whatever its rank
    core, clustered = min(core, len(top)), min(clustered, len(top))
    words = [w for _, w in top]
    number = {w: i for i, w in enumerate(words)}
    core_numbers = {w: i for i, w in enumerate(words[:core])}

    def neighbours(numbers: np.ndarray, end: int) -> np.ndarray:
        return _before(numbers, end) * (1 << 32) + numbers

    shared = spark.sparkContext.broadcast((core_numbers, core, core_numbers.get(END, core)))
    pairs = np.zeros((core + 1, core + 1))
    before, after, n = _gathered(_pair_counts(rows, shared, neighbours))  # at most (core + 1) squared numbers
    pairs[before, after] = n
    core_class = exchange_classes(pairs, classes)

    # One exchange step for the words that follow: counts of (class before, word), grouped by word.
    hot = np.zeros((core + 1, classes + 1))
    hot[np.arange(core + 1), core_class] = 1
    table = hot.T @ pairs @ hot + 0.1
    logs = spark.sparkContext.broadcast(np.log(table / table.sum(axis=0)))
    shared = spark.sparkContext.broadcast((words, core_class, core, classes + 1))
    classed = written(_word_classes(_context_counts(rows, shared), logs), "word-classes")
    class_of = np.full(len(top) + 1, classes)
    class_of[:core] = core_class[:-1]
    table = classed.filter("number is not null").select("number", "class").toArrow()  # bounded by the head's size
    at, own = table["number"].to_numpy(), table["class"].to_numpy()
    frequent = (at < clustered) | (np.array([n for n, _ in top] or [0])[at] >= least)
    class_of[at[frequent]] = own[frequent]
    tail = classed.filter("number is null")
    tail = tail.select("word", "n", F.when(F.col("n") >= least, F.col("class")).otherwise(classes).alias("class"))

    tokens_in, words_in = np.zeros(classes + 1), np.zeros(classes + 1)
    for c, n, k in tail.groupBy("class").agg(F.sum("n"), F.count("*")).collect():
        tokens_in[c] += n
        words_in[c] += k
    known: dict[bytes, tuple[int, int]] = {}
    for (n, w), c in zip(top, class_of.tolist()):
        known[w] = (n, c)
        tokens_in[c] += n
        words_in[c] += 1
    tokens_in[classes] += total - tokens_in.sum()
    words_in[classes] += distinct - words_in.sum()
    return Vocabulary(known, total, distinct, tokens_in, words_in), tail


def coded(
    docs: DataFrame, words: Vocabulary, tail: DataFrame, text_col: str = "text", carried: tuple[str, ...] = (),
    learn: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One pass over the texts, written. Texts: (row, carried, learn, n, n_known,
    counts: sum of the logs of the words' counts, classes: a byte a word, ``TAIL``
    for those outside the head). Neighbours of which one or both stand outside the
    head: (row, learn, n, a, b, b_count), met with the tail's counts and classes by joins."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(words)  # bounded by the head's size
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), *[docs[c].alias(c) for c in carried],
        (F.lit(True) if learn is None else learn).alias("learn"), docs[text_col].cast("string").alias("text"),
    )
    lead = [f for f in rows.schema.fields if f.name not in ("row", "learn", "text")]
    names, kinds = [f.name for f in lead], "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in lead)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        number = {w: i for i, w in enumerate(own.head)}
        rare, end = len(number), number.get(END, len(number))
        outside = TAIL if own.has_tail else own.other
        count = np.array([n for n, _ in own.head.values()] + [0], np.float64)
        cls = np.array([c for _, c in own.head.values()] + [outside], np.uint8)
        log_count = np.log10(count + 1)
        empty = [pa.nulls(0, t) for t in (pa.int32(), pa.binary(), pa.int32(), pa.binary())]
        columns = ["row", *names, "learn", "n", "n_known", "counts", "classes", "a", "a_word", "b", "b_word"]
        for batch, texts in _batches(batches):
            flat, size = _flat(texts)
            numbers = _numbers(flat, number, rare)
            stop = np.cumsum(size)
            first, own_classes = stop - size, cls[numbers].tobytes()
            sums = [np.add.reduceat(x, first) for x in (log_count[numbers], (count[numbers] > 0).astype(np.int64))] if texts else [np.zeros(0)] * 2
            learned = batch.column(1 + len(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(batch.column(1 + i) for i in range(len(names))), learned, pa.array(size),
                 pa.array(sums[1].astype(np.int64)), pa.array(sums[0]),
                 pa.array([own_classes[i:j] for i, j in zip(first.tolist(), stop.tolist())], pa.binary()),
                 *(pa.nulls(len(texts), x.type) for x in empty)], names=columns,
            )
            if not own.has_tail:
                continue
            at, pairs = _tail_pairs(flat, numbers, cls, rare, end)
            if n := at.size:
                doc = pa.array(np.repeat(np.arange(size.size), size)[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(doc), *(pa.nulls(n, batch.column(1 + i).type) for i in range(len(names))), learned.take(doc),
                     pa.array(np.ones(n, np.int64)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.binary()), *pairs],
                    names=columns,
                )

    made = written(rows.mapInArrow(
        run, f"row long, {kinds}learn boolean, n long, n_known long, counts double, classes binary, a int, a_word binary, b int, b_word binary"
    ), "coded")
    found = made.filter("n_known is null").select("row", "learn", "n", "a", "a_word", "b", "b_word")
    for side in ("a", "b"):
        found = _class_of_tail(found, tail, side, words.other)
    texts = made.filter("n_known is not null").drop("a", "a_word", "b", "b_word")
    return texts, written(found.select("row", "learn", "n", "a", "b", "b_count"), "tail-neighbours")


def _known_neighbours(classes: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the words of all texts in turn: class before, class, whether both are
    known, and where each text begins."""
    size = np.array([len(c) for c in classes], np.int64)
    own = np.frombuffer(b"".join(classes), np.uint8)
    first = np.cumsum(size) - size
    before = np.concatenate((np.zeros(min(1, own.size), np.uint8), own[:-1]))
    before[first] = end
    return before, own, (before != TAIL) & (own != TAIL), first


def class_links(texts: DataFrame, neighbours: DataFrame, words: Vocabulary) -> np.ndarray:
    """How often each class follows each, over the texts and neighbours to learn from."""
    size, end = words.other + 1, words.head[END][1] if END in words.head else words.other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size * size, np.int64)
        for batch in slices(batches, "classes", 4 << 20):
            before, own, known, _ = _known_neighbours(batch.column(0).to_pylist(), end)
            table += np.bincount(before[known].astype(np.int64) * size + own[known], minlength=size * size)
        at = np.nonzero(table)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array((at // size).astype(np.int32)), pa.array((at % size).astype(np.int32)), pa.array(table[at])], names=["a", "b", "n"])

    inside = texts.filter("learn").select("classes").mapInArrow(run, "a int, b int, n long")
    counted = inside.unionByName(neighbours.filter("learn").select("a", "b", "n")).groupBy("a", "b").agg(F.sum("n").alias("n"))
    table, links = counted.toArrow(), np.zeros((size, size))  # at most size squared rows
    links[table["a"].to_numpy(), table["b"].to_numpy()] = table["n"].to_numpy()
    return links


def train(rows: DataFrame, weight: float = WEIGHT, **options) -> tuple[BrownModel, Vocabulary, DataFrame]:
    """The model, its vocabulary and the words outside the head (word, n, class),
    from the text column of ``rows``; ``options`` are those of ``vocabulary``."""
    words, tail = vocabulary(rows, **options)
    return BrownModel(words, class_links(*coded(rows, words, tail), words), weight), words, tail


def scores(texts: DataFrame, neighbours: DataFrame, model: BrownModel, carried: tuple[str, ...]) -> DataFrame:
    """One row for each coded text: the carried columns, n_tokens, n_known,
    train_tokens, base_score, score."""
    spark, other = texts.sparkSession, model.other
    shared = spark.sparkContext.broadcast((model.link, model.head[END][1] if END in model.head else other))
    kept = [c for c in texts.columns if c != "classes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        link, end = shared.value
        for batch in slices(batches, "classes", 4 << 20):
            at = batch.schema.names.index("classes")
            before, own, known, first = _known_neighbours(batch.column(at).to_pylist(), end)
            linked = np.zeros(own.size)
            linked[known] = link[before[known], own[known]]
            sums = np.add.reduceat(linked, first) if first.size else linked
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sums)], names=[*kept, "links"])

    schema = T.StructType([*[texts.schema[c] for c in kept], T.StructField("links", T.DoubleType())])
    link = spark.createDataFrame([(a, b, float(x)) for (a, b), x in np.ndenumerate(model.link)], "_a int, _b int, _link double")
    more = (
        neighbours.join(F.broadcast(link), (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")))
        .groupBy(F.col("row").alias("_row")).agg(
            F.sum(F.col("n") * F.log10(F.coalesce("b_count", F.lit(0)) + 1)).alias("_counts"),
            F.sum(F.col("n") * F.col("_link")).alias("_links"),
            F.sum(F.when(F.col("b_count") > 0, F.col("n")).otherwise(0)).alias("_known"),
        )
    )
    own = texts.mapInArrow(run, schema).join(more, F.col("row") == F.col("_row"), "left")
    logs = F.col("counts") + F.coalesce("_counts", F.lit(0.0))
    return own.select(
        *[F.col(f"`{c}`") for c in carried], F.col("n").alias("n_tokens"),
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (logs + F.col("n") * math.log10(model.uniform)).alias("base_score"),
        (logs + F.col("links") + F.coalesce("_links", F.lit(0.0))).alias("score"),
    )


def score(docs: DataFrame, model: BrownModel, words: Vocabulary, tail: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score, score."""
    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return scores(*coded(named, words, tail, carried=("id",)), model, ("id",))


def score_corpus(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", weight: float = WEIGHT, **options
) -> DataFrame:
    """Trains on the rows for which ``held_out`` is false and scores all; the
    texts are coded once for both."""
    marked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                         F.coalesce(held_out, F.lit(False)).alias("held_out"))
    words, tail = vocabulary(marked.filter("not held_out").select("text"), **options)
    texts, neighbours = coded(marked, words, tail, carried=("id", "held_out"), learn=~F.col("held_out"))
    model = BrownModel(words, class_links(texts, neighbours, words), weight)
    return scores(texts, neighbours, model, ("id", "held_out"))
