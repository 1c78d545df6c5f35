"""Quality by logistic regression on hashed word n-grams.

Features of a text: its words, lower-cased, and the shapes of its words
(every run of lower-case letters, capitals, digits or other letters written
as one character, marks kept), as n-grams of one and two (a word and itself
again: one n-gram for all words), hashed to ``2**BITS`` weights.  An occurrence counts 1 / n where n is the number of
words, so a score is one sparse dot product of length-free counts, pushed
through the logistic function.

Training: follow the (proximally) regularised leader with per-coordinate
rates, on a bounded sample of labelled texts dealt to ``SHARDS`` tasks; each
makes ``EPOCHS`` passes over its share, and the weights are the mean over
tasks (parameter mixing).

Null and empty texts have no features and get the score of the intercept.
Repeated rows: each is scored.  Without labelled texts every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import LOWER, U64, WHITE_SPACE, Chunk, chunks, hash_spans, ngrams, spans

BITS = 18
SHARDS = 8
EPOCHS = 6
#: Labelled texts the weights are fitted on at most, those with the smallest
#: hashes of their doc_id; scoring covers every row.
MAX_EXAMPLES = 12_000
# Learning rate, its smoothing, and the two penalties of the leader.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-4
#: Weight of one share of a text: counts are shares times this.
SCALE = 10.0

# Character classes that a shape keeps apart; other bytes stand for themselves.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[0x80:] = 1


def _shapes(c: Chunk, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words' shapes: of each run of one class one byte."""
    kind = _CLASS[c.data]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return hash_spans(kind[keep], at[starts], at[ends])


def features(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight numbers of all n-grams of a chunk, the document each belongs to
    (as position in the chunk) and each document's number of words."""
    starts, ends, first = spans(c, WHITE_SPACE)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    lower = LOWER[c.data]
    out, of = [], []
    for salt, h in enumerate((hash_spans(lower, starts, ends), _shapes(c, starts, ends))):
        for k in (1, 2):
            g = ngrams(h, k)
            if k == 2:  # a word said twice is one n-gram, whatever the word
                g = np.where(h[:-1] == h[1:], U64(0), g)
            inside = doc[: len(g)] == doc[k - 1 :]
            out.append(((g[inside] ^ U64(0x9E3779B97F4A7C15 * (2 * salt + k) % 2**64)) >> U64(64 - BITS)).astype(np.int32))
            of.append(doc[: len(g)][inside])
    return np.concatenate(out), np.concatenate(of), n


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, features (numbers), counts (length-free) of each text."""
    for b in batches:
        for c in chunks(b.column(1)):
            at, doc, n = features(c)
            order = np.argsort(doc, kind="stable")
            cuts = np.searchsorted(doc[order], np.arange(len(n) + 1))
            idx, val = [], []
            for k in range(len(n)):
                u, m = np.unique(at[order[cuts[k] : cuts[k + 1]]], return_counts=True)
                idx.append(u)
                val.append((m * (SCALE / max(1, n[k]))).astype(np.float32))
            yield pa.record_batch(
                [b.column(0).slice(c.lo, len(n)), pa.array(idx, pa.list_(pa.int32())), pa.array(val, pa.list_(pa.float32()))], names=["label", "at", "count"]
            )


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's passes: at, w of the weights that aren't 0; at -1: the
    intercept."""
    rows = [(label, at.values.to_numpy(), count.values.to_numpy()) for b in batches for label, at, count in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True)]
    if not rows:
        return
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    rows = [(y, np.append(at, 1 << BITS), np.append(x, np.float32(1))) for y, at, x in rows]

    def weights(at: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z[at]) <= L1, 0, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            y, at, x = rows[k]
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(len(z)))
    at = np.flatnonzero(w)
    yield pa.record_batch([pa.array(np.append(np.where(at == 1 << BITS, -1, at), -2).astype(np.int32)), pa.array(np.append(w[at], 1.0))], names=["at", "w"])


def sample(docs: DataFrame, labels: DataFrame, learn: F.Column, rows: int = MAX_EXAMPLES) -> DataFrame:
    """label, text of the bounded sample; ``learn`` is a condition on the
    labels' doc_id.  At most ``rows`` labels meet the documents."""
    few = labels.where(learn & F.col("quality").isNotNull()).select("doc_id", F.col("quality").cast("double").alias("label"))
    few = few.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "label").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("label", "text")


def train(examples: DataFrame) -> np.ndarray:
    """Weights, the intercept last; at most 2**BITS + 1 come to the driver."""
    dealt = examples.select("label", "text").mapInArrow(_examples, "label double, at array<int>, count array<float>").repartition(SHARDS)
    sums = {r["at"]: r["w"] for r in dealt.mapInArrow(_lead, "at int, w double").groupBy("at").agg(F.sum("w").alias("w")).collect()}
    w = np.zeros((1 << BITS) + 1)
    shards = sums.pop(-2, 1.0)
    for at, x in sums.items():
        w[at] = x / shards  # -1: the last, the intercept
    return w


def score_batch(w: np.ndarray, texts: pa.Array) -> np.ndarray:
    out = np.zeros(len(texts))
    for c in chunks(texts):
        at, doc, n = features(c)
        out[c.lo : c.hi] = np.bincount(doc, weights=w[at], minlength=len(n)) * (SCALE / np.maximum(n, 1))
    return 1 / (1 + np.exp(-np.clip(out + w[-1], -35, 35)))


def score(docs: DataFrame, w: np.ndarray) -> DataFrame:
    """doc_id, score; the weights are 2 MB, whatever the input."""
    shared = docs.sparkSession.sparkContext.broadcast(w)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(score_batch(shared.value, b.column(1)))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
