"""Periodic runs of words, found with a run-length grammar made by recompression.

A run is a stretch of words with smallest period q, at least ``exponent`` times
q and ``least`` words long, that no neighbouring word extends with that period.

1. Grammar. The words of a batch of documents, as numbers with a separator
   before, between and after the documents, are compressed level by level, in
   turn by blocks (equal neighbours a...a become one symbol) and by pairs (each
   level deals the symbols into left and right ones; a left one before a right
   one becomes one symbol), until little more than a symbol a document is left.
   Equal stretches are compressed alike but for their ends.
2. Longest common extensions of two places go up through the levels, a few
   symbol comparisons each, until they meet unlike symbols, and down again into
   those. Backwards alike. All queries go together, one level at a time.
3. Candidates. A run of period p leaves (exponent - 1) p places in a row whose
   word recurs p words on, so one of them is a multiple of (exponent - 1) p:
   these grids, a harmonic sum of places over all p, miss none. The extensions
   of each candidate give the run exactly. Smaller periods come first, so a run
   found again with a multiple of its period is known by its ends.

Whole documents go through one task each, batches hold a bounded size of text
(one document at least). No suffix arrays are made.

Null and empty texts have no words and no runs; very long ones are taken whole.
Repeated rows are treated each;
an empty table gives no rows; all other columns, of any name, come back in one
struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import ROW, encoded, ship_by_value, slices

ship_by_value(__name__)

EXPONENT, LEAST = 4, 6
CHUNK = 1 << 20  # candidates looked at together
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


@dataclass
class Level:
    """A sequence of symbols, and how the level above groups them.

    ``begins[i]``: a symbol of the level above begins at i. ``up[i]``: the number
    of such symbols before i. ``down``: where each of them begins. ``first`` and
    ``past``: the block that a place is in, at a level of blocks."""

    symbols: np.ndarray
    begins: np.ndarray | None = None
    up: np.ndarray | None = None
    down: np.ndarray | None = None
    first: np.ndarray | None = None
    past: np.ndarray | None = None


@dataclass
class Grammar:
    """``levels`` from the words up, and the rules: symbol -> (left, right), or
    (symbol, how often) for those of blocks. Negative symbols are separators."""

    levels: list[Level]
    pairs: dict[int, tuple[np.ndarray, np.ndarray]]
    blocks: dict[int, tuple[np.ndarray, np.ndarray]]

    def expand(self, symbol: int) -> list[int]:
        """The words of a symbol."""
        out, stack = [], [symbol]
        starts = sorted([*self.pairs, *self.blocks])
        while stack:
            x = stack.pop()
            at = np.searchsorted(starts, x, side="right") - 1
            if at < 0:
                out.append(x)
            elif starts[at] in self.pairs:
                left, right = self.pairs[starts[at]]
                stack += [int(right[x - starts[at]]), int(left[x - starts[at]])]
            else:
                one, often = self.blocks[starts[at]]
                stack += [int(one[x - starts[at]])] * int(often[x - starts[at]])
        return out


def _side(symbols: np.ndarray, level: int) -> np.ndarray:
    """Left (True) or right, by a hash of the symbol that differs from level to level."""
    x = symbols.astype(np.uint64) + np.uint64((level * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(63)).astype(bool)


def recompress(symbols: np.ndarray) -> Grammar:
    """Grammar of a sequence: symbols from 0 up, separators negative and all different."""
    grammar = Grammar([Level(symbols)], {}, {})
    new, separators = int(symbols.max(initial=-1)) + 1, int((symbols < 0).sum())
    for k in range(128):
        level = grammar.levels[-1]
        x = level.symbols
        n = x.size
        if n <= 3 * separators and k > 8:
            break
        begins = np.ones(n + 1, bool)
        if k % 2 == 0:  # blocks
            begins[1:n] = x[1:] != x[:-1]
        else:
            left = _side(x, k)
            ok = x >= 0
            begins[1:n] = ~(left[:-1] & ~left[1:] & ok[:-1] & ok[1:])
        down = np.flatnonzero(begins)
        level.begins, level.up, level.down = begins, np.cumsum(begins) - begins, down
        down, size = down[:-1], np.diff(down)
        above = x[down].copy()
        many = size > 1
        if k % 2 == 0:
            level.first = np.repeat(down, size)
            level.past = np.repeat(down + size, size)
            a, b, rules = above[many], size[many], grammar.blocks
        else:
            a, b, rules = above[many], x[down[many] + 1], grammar.pairs
        if a.size:
            code, seen = pd.factorize(a * (new + n) + b)
            above[many] = new + code
            rules[new] = (seen // (new + n), seen % (new + n))
            new += seen.size
        grammar.levels.append(Level(above))
    return grammar


def extensions(grammar: Grammar, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
    """How many symbols from places i and j on (``back``: before them) are equal.

    i and j differ; a separator stands at either end of what they may reach."""
    levels, turn = grammar.levels, -1 if back else 1
    here = -1 if back else 0  # the symbol next to a place
    pi, pj = i.copy(), j.copy()
    met = np.full(i.size, len(levels) - 1)  # the level of the unlike symbols
    live = np.arange(i.size)

    def step(level: Level, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """From places next to equal symbols over as many as the shorter block has."""
        if level.first is None:
            return np.full(a.size, turn)
        if back:
            return -np.minimum(a - level.first[a - 1], b - level.first[b - 1])
        return np.minimum(level.past[a] - a, level.past[b] - b)

    for k, level in enumerate(levels):
        top, climbing = level.begins is None, live
        arrived = []
        while climbing.size:
            a, b = pi[climbing], pj[climbing]
            same = level.symbols[a + here] == level.symbols[b + here]
            met[climbing[~same]] = k
            climbing, a, b = climbing[same], a[same], b[same]
            if not top:
                both = level.begins[a] & level.begins[b]
                arrived.append(climbing[both])
                climbing, a, b = climbing[~both], a[~both], b[~both]
            over = step(level, a, b)
            pi[climbing] += over
            pj[climbing] += over
        if top:
            break
        live = np.concatenate(arrived) if arrived else live[:0]
        if not live.size:
            break
        pi[live], pj[live] = level.up[pi[live]], level.up[pj[live]]
    for k in range(int(met.max(initial=0)) - 1, -1, -1):
        level = levels[k]
        sinking = np.flatnonzero(met > k)
        pi[sinking], pj[sinking] = level.down[pi[sinking]], level.down[pj[sinking]]
        while sinking.size:
            a, b = pi[sinking], pj[sinking]
            same = level.symbols[a + here] == level.symbols[b + here]
            sinking, a, b = sinking[same], a[same], b[same]
            over = step(level, a, b)
            pi[sinking] += over
            pj[sinking] += over
    return np.abs(pi - i)


def _candidates(first: np.ndarray, sizes: np.ndarray, exponent: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of all grids, periods ascending within each document, by chunks of whole documents' periods."""
    most = np.where(sizes >= least, sizes // exponent, 0)  # the largest period of each document
    doc = np.repeat(np.arange(sizes.size), most)
    period = np.arange(most.sum()) - np.repeat(np.cumsum(most) - most, most) + 1
    grid = (exponent - 1) * period
    many = (sizes[doc] - period - 1) // grid + 1
    ends = np.cumsum(many)
    at = 0
    while at < doc.size:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - many[at] + CHUNK)))
        n = many[at:to]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(first[doc[at:to]], n) + nth * np.repeat(grid[at:to], n), np.repeat(period[at:to], n)
        at = to


def periodic_runs(
    words: np.ndarray, sizes: np.ndarray, exponent: int = EXPONENT, least: int = LEAST
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, by document, start and period.

    ``words``: word numbers of all documents in turn; ``sizes``: how many each has."""
    docs = sizes.size
    first = np.cumsum(sizes) - sizes + np.arange(docs) + 1  # after the separators
    symbols = np.empty(words.size + docs + 1, np.int64)
    between = np.append(first - 1, symbols.size - 1)
    symbols[between] = -1 - np.arange(docs + 1)
    inner = np.ones(symbols.size, bool)
    inner[between] = False
    symbols[inner] = words
    grammar, found = None, []
    for place, period in _candidates(first, sizes, exponent, least):
        same = symbols[place] == symbols[place + period]
        place, period = place[same], period[same]
        if not place.size:
            continue
        grammar = grammar or recompress(symbols)
        after = extensions(grammar, place, place + period)
        # a run has no room for its length if even both whole documents' ends were reached
        before = extensions(grammar, place, place + period, back=True)
        length = before + after + period
        long = length >= np.maximum(least, exponent * period)
        found.append((place[long] - before[long], length[long], period[long]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    start, length, period = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(start.size, bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])  # else a multiple of the period before
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    doc = np.searchsorted(first, start, side="right") - 1
    return doc, start - first[doc], length, period


def _runs_of(batches: Iterator[pa.RecordBatch], exponent: int, least: int, limit: int) -> Iterator[pa.RecordBatch]:
    kinds = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
    for batch in slices(batches, "text", limit):
        texts = [t.split() for t in encoded(batch.column(1))]
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = np.empty(int(sizes.sum()), object)
        flat[:] = [w for t in texts for w in t]
        words = pd.factorize(flat)[0].astype(np.int64)
        doc, start, length, period = periodic_runs(words, sizes, exponent, least)
        # a word is dropped where a run holds it after that run's first period
        edge = np.zeros(flat.size + 1, np.int64)
        base = (np.cumsum(sizes) - sizes)[doc]
        np.add.at(edge, base + start + period, 1)
        np.add.at(edge, base + start + length, -1)
        kept = np.cumsum(edge)[:-1] == 0
        collapsed, at = [], 0
        for t in texts:
            own = kept[at : at + len(t)]
            collapsed.append(b" ".join(t if own.all() else [w for w, k in zip(t, own.tolist()) if k]))
            at += len(t)
        runs = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], ["start", "length", "period"])
        cuts = np.searchsorted(doc, np.arange(sizes.size + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(cuts), runs).cast(kinds),
             pa.array(collapsed, pa.binary()).cast(pa.string())], names=[ROW, "n_words", "runs", "collapsed"],
        )


def find_runs(
    docs: DataFrame, text_col: str = "text", exponent: int = EXPONENT, least: int = LEAST, batch_bytes: int = 4 << 20
) -> DataFrame:
    """(row struct without the text, ``n_words``, ``runs``: (start, length, period) by start and period,
    ``collapsed``: the text's words, joined by one space, less those in a run after its first period).

    ``exponent`` is a whole number from 2 up."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias(ROW)
    narrow = docs.select(rest, F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([
        T.StructField(ROW, narrow.schema[ROW].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType()),
    ])
    return narrow.mapInArrow(partial(_runs_of, exponent=exponent, least=least, limit=batch_bytes), schema)
