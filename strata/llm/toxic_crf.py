"""Toxicity by a linear-chain conditional random field over words.

Labels mark documents: a clean document has no toxic word, a toxic one at least
one. A two-state chain with weights for a word, its first bytes and its
neighbours is fitted to just that, by gradient ascent on the log-likelihood of
the documents' labels: the chance that all words are clean comes from the same
forward pass as the marginals, so no word list stands between labels and
tokens, and toxic words may be many and rare. Forward-backward marginals then
give each word's chance of being toxic in every document; their largest value
and sum, through a logistic curve fitted on the training documents, make the
document's score, and words above one half its offending spans.

Chains are ``CHAIN`` consecutive words (all words of a text lie in one), so a
very long text is many short chains. The fit uses a bounded sample of labelled
documents (``sample_docs`` of each label, by hash of the id); scoring covers
every document. Null and empty texts have no words and get the score of a text
without toxic words. Without labels of both kinds every score is the share of
toxic labels (0 without labels). Repeated rows are scored alike, and in the
sample texts that are equal count once; an empty table gives no rows; other
columns are not kept, so their names clash with none of the result's.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import encoded, ship_by_value, slices

ship_by_value(__name__)

CHAIN = 64
SAMPLE_DOCS = 2000
FOLDS = 3
PREFIX = 5
SAMPLE_BYTES = 16384
LEAST_HELD = 3  # documents that hold a word of the vocabulary
# Bytes of words: digits, letters (A-Z lower-cased) and everything beyond ASCII.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
SPANS = "array<struct<start:int,stop:int>>"


def longest(words: list[bytes]) -> bytes:
    return max(words, key=lambda w: (len(w), w), default=b"")


class Chain:
    """Two states; weights u of a word, q of its first bytes, l and r of its
    left and right neighbour for the toxic state, and a 2 x 2 table of
    transitions (weight of a pair)."""

    def __init__(self, vocabulary: list[bytes]) -> None:
        self.ids = {w: i + 1 for i, w in enumerate(vocabulary)}  # 0: any other word
        self.prefixes = {x: i + 1 for i, x in enumerate(sorted({w[:PREFIX] for w in vocabulary}))}
        n = len(vocabulary) + 1
        self.u, self.l, self.r = np.zeros(n), np.zeros(n), np.zeros(n)
        self.q = np.zeros(len(self.prefixes) + 1)
        self.t = np.zeros((2, 2))
        self.curve = np.zeros(3)  # document score: bias, largest marginal, log of 1 + sum

    def chains(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, used, doc): rows of CHAIN word ids (and, behind them, prefix ids),
        which of them are words, the row's document."""
        get, get_prefix = self.ids.get, self.prefixes.get
        sizes = np.array([len(d) for d in docs], np.int64)
        rows = -(-sizes // CHAIN)
        doc = np.repeat(np.arange(len(docs)), rows)
        flat = np.fromiter((get(w, 0) for d in docs for w in d), np.int64, int(sizes.sum()))
        first = (np.cumsum(rows) - rows) * CHAIN
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(flat.size)
        starts = np.fromiter((get_prefix(w[:PREFIX], 0) for d in docs for w in d), np.int64, flat.size)
        ids, used = np.zeros((2, doc.size * CHAIN), np.int64), np.zeros(doc.size * CHAIN, bool)
        ids[0, at], ids[1, at], used[at] = flat, starts, True
        return ids.reshape(2, -1, CHAIN), used.reshape(-1, CHAIN), doc

    def evidence(self, ids: np.ndarray) -> np.ndarray:
        """Weight of the toxic over the clean state at each word, before its chain is looked at."""
        words, starts = ids
        e = self.u[words] + self.q[starts]
        e[:, 1:] += self.l[words[:, :-1]]
        e[:, :-1] += self.r[words[:, 1:]]
        return e

    def messages(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward (own evidence included) and backward log odds of the toxic state,
        and the log of the chance that a whole chain is clean."""
        t = np.exp(self.t)
        f, b = np.empty_like(e), np.zeros_like(e)
        f[:, 0] = e[:, 0]
        total = np.zeros(len(e))  # log weight of all ways that end clean
        for k in range(1, e.shape[1]):
            odds = np.exp(f[:, k - 1])
            from_clean = np.log(t[0, 0] + odds * t[1, 0])
            total += from_clean
            f[:, k] = e[:, k] + np.log(t[0, 1] + odds * t[1, 1]) - from_clean
        for k in range(e.shape[1] - 2, -1, -1):
            odds = np.exp(e[:, k + 1] + b[:, k + 1])
            b[:, k] = np.log((t[1, 0] + odds * t[1, 1]) / (t[0, 0] + odds * t[0, 1]))
        clean = (e.shape[1] - 1) * self.t[0, 0] - total - np.logaddexp(0, f[:, -1])
        return f, b, clean

    def marginals(self, ids: np.ndarray, used: np.ndarray) -> np.ndarray:
        f, b, _ = self.messages(np.where(used, np.clip(self.evidence(ids), -30, 30), -30.0))
        return np.where(used, 1 / (1 + np.exp(-np.clip(f + b, -60, 60))), 0.0)

    def fit(self, ids: np.ndarray, used: np.ndarray, doc: np.ndarray, toxic: np.ndarray, rounds: int = 40, rate: float = 0.5) -> None:
        """Gradient ascent (Adagrad) on the log-likelihood of the documents' labels.

        With c the chance that a document is all clean, log c of a clean one grows
        by what clean words have less what is expected; log(1 - c) of a toxic one by
        c / (1 - c) times the opposite."""
        pair = used[:, 1:] & used[:, :-1]
        words, starts = ids
        weights = {"u": np.zeros_like(self.u), "q": np.zeros_like(self.q), "l": np.zeros_like(self.l), "r": np.zeros_like(self.r)}
        total_t = np.zeros((2, 2))
        self.u[:] = -2.0
        n = self.u.size
        for _ in range(rounds):
            e = np.where(used, np.clip(self.evidence(ids), -30, 30), -30.0)
            f, b, clean = self.messages(e)
            p = 1 / (1 + np.exp(-np.clip(f + b, -60, 60)))
            clean = np.minimum(np.bincount(doc, clean, toxic.size), -1e-9)
            pull = np.where(toxic == 1, np.exp(clean) / -np.expm1(clean), -1.0)[doc]
            miss = np.where(used, pull[:, None] * p, 0.0)
            steps = {
                "u": np.bincount(words.ravel(), miss.ravel(), n),
                "q": np.bincount(starts.ravel(), miss.ravel(), self.q.size),
                "l": np.bincount(words[:, :-1].ravel(), miss[:, 1:].ravel(), n),
                "r": np.bincount(words[:, 1:].ravel(), miss[:, :-1].ravel(), n),
            }
            for name, step in steps.items():
                step -= 0.01 * getattr(self, name)
                weights[name] += step**2
                getattr(self, name)[:] += rate * step / np.sqrt(weights[name] + 1e-6)
            # expected transitions, from the pair marginals of neighbouring words
            left, right = f[:, :-1], e[:, 1:] + b[:, 1:]
            joint = np.stack(
                [self.t[x, y] + x * left + y * right for x in (0, 1) for y in (0, 1)], axis=0
            )
            joint = np.exp(joint - joint.max(axis=0))
            joint /= joint.sum(axis=0)
            joint[0] -= 1  # an all clean document has this pair everywhere
            step = np.where(pair, joint * pull[:, None], 0.0).sum(axis=(1, 2)).reshape(2, 2) - 0.01 * self.t
            total_t += step**2
            self.t += rate * 0.3 * step / np.sqrt(total_t + 1e-6)

    def document_features(self, p: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
        """(n_docs, 3): one, largest marginal, log of 1 + sum of marginals above a tenth."""
        out = np.zeros((n_docs, 3))
        out[:, 0] = 1
        np.maximum.at(out[:, 1], doc, p.max(axis=1) if p.size else np.zeros(0))
        np.add.at(out[:, 2], doc, np.where(p > 0.1, p, 0.0).sum(axis=1))
        out[:, 2] = np.log1p(out[:, 2])
        return out

    def fit_curve(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Logistic regression by Newton steps with a small ridge."""
        c = np.zeros(3)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
            gradient = x.T @ (weight * (y - p)) - 0.01 * c
            hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3)
            c += np.linalg.solve(hessian, gradient)
        self.curve = c

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.curve, -30, 30)))


def _fitted(docs: list[list[bytes]], toxic: np.ndarray, vocabulary: int) -> Chain:
    """Words of fewer than ``LEAST_HELD`` documents tell nothing that other documents share."""
    held = Counter(w for d in docs for w in set(d))
    chain = Chain(sorted(w for w, n in held.most_common(vocabulary) if n >= LEAST_HELD))
    ids, used, doc = chain.chains(docs)
    chain.fit(ids, used, doc, toxic)
    return chain


def fit_chain(texts: list[bytes], toxic: np.ndarray, share: float, vocabulary: int = 20_000) -> Chain:
    """The chain and its document curve; ``share`` is the share of toxic labels,
    to which the (label-balanced) sample is weighted back. The curve is fitted to
    documents that the chain scoring them has not seen: folds, near copies in
    the same one, each scored by the chain of the others."""
    once = sorted({(t, y): i for i, (t, y) in enumerate(zip(texts, toxic.tolist()))}.values())
    docs, toxic = [texts[i].translate(WORD_BYTES).split() for i in once], toxic[once]
    fold = np.array([zlib.crc32(longest(d)) % FOLDS for d in docs])
    x = np.zeros((len(docs), 3))
    x[:, 0] = 1
    for own in range(FOLDS):
        seen, unseen = np.nonzero(fold != own)[0], np.nonzero(fold == own)[0]
        if seen.size and unseen.size:
            chain = _fitted([docs[i] for i in seen], toxic[seen], vocabulary)
            ids, used, doc = chain.chains([docs[i] for i in unseen])
            x[unseen] = chain.document_features(chain.marginals(ids, used), doc, unseen.size)
    chain = _fitted(docs, toxic, vocabulary)
    weight = np.where(toxic == 1, share / max(toxic.mean(), 1e-9), (1 - share) / max(1 - toxic.mean(), 1e-9))
    chain.fit_curve(x, toxic.astype(float), weight)
    return chain


def training_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_label: int, max_bytes: int
) -> tuple[list[bytes], np.ndarray, float]:
    """Texts and labels of at most ``per_label`` documents of each label (the
    least hashes of the id; texts of at most ``max_bytes``), and the share of
    toxic labels. Bounded by the two parameters."""
    marks = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    marks = marks.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_toxic"))
    n, share = marks.agg(F.count("*"), F.avg("_toxic")).first()
    if not n:
        return [], np.zeros(0, np.int64), 0.0
    held = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    held = held.filter(F.octet_length("_text") <= max_bytes)
    # ids of labelled documents with a text of that size; no text is shuffled for them
    fit = marks.join(held.select("_id").distinct(), "_id", "left_semi")
    texts, found = [], []
    for value in (0, 1):
        ids = fit.filter(F.col("_toxic") == value).orderBy(F.xxhash64("_id"), "_id").limit(per_label)
        rows = held.join(F.broadcast(ids), "_id").groupBy("_id").agg(F.min("_text").alias("_text"))
        own = [r["_text"].encode() for r in rows.orderBy("_id").collect()]
        texts += own
        found += [value] * len(own)
    return texts, np.array(found, np.int64), float(share)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, score (0 to 1), spans (character ranges of
    the words that are likelier toxic than not). ``labels`` are what to learn from."""
    texts, toxic, share = training_sample(docs, labels, id_col, text_col, label_col, sample_docs, sample_bytes)
    chain = fit_chain(texts, toxic, share) if 0 < toxic.sum() < toxic.size else None
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # vocabulary bounded by fit_chain
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    one_word = re.compile(rb"[^ ]+")

    def spans_of(text: bytes, at: list[int]) -> list[dict]:
        places = [m.span() for m in one_word.finditer(text.translate(WORD_BYTES))]
        out = []
        for i in at:
            a, b = places[i]
            start = len(text[:a].decode())
            out.append({"start": start, "stop": start + len(text[a:b].decode())})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, "text", 2 << 20):
            n = batch.num_rows
            spans: list[list] = [[] for _ in range(n)]
            if own is None:
                score = np.full(n, share)
            else:
                texts_here = encoded(batch.column(1))
                ids, used, doc = own.chains([t.translate(WORD_BYTES).split() for t in texts_here])
                p = own.marginals(ids, used)
                score = own.scores(own.document_features(p, doc, n))
                row, at = np.nonzero(p > 0.5)
                first = np.searchsorted(doc, np.arange(n))  # a document's first chain
                word = (row - first[doc[row]]) * CHAIN + at
                for d in np.unique(doc[row]).tolist():
                    spans[d] = spans_of(texts_here[d], sorted(word[doc[row] == d].tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array(spans, span_type)], names=["id", "score", "spans"]
            )

    return rows.mapInArrow(run, f"id {kind}, score double, spans {SPANS}")
