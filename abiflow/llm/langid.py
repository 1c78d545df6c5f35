"""Language by prediction by partial matching over bytes.

For each language a byte context tree of depth ``ORDER`` is counted on a
bounded sample of labelled texts and then frozen.  A byte's probability in a
context is its count over the context's total plus number of distinct bytes
(escape method C); with what is left, the escape, the next shorter context
speaks about the bytes not yet seen, down to a uniform guess.  So each
context holds a full distribution, and the code length of a text under a
language is the exact sum of -log2 of its bytes' probabilities.  Frozen
trees make that a function of the last bytes alone: one table holds the bits
of each (context, byte) that any language saw, for all languages, another the
bits of each context's escapes, and a task reads them with array lookups.

The prediction is the language with the shortest code (ties: the first
name), its score the posterior probability of that language when all are
equally likely beforehand.  A text that is null or has no letter is ``und``
with score 0.  Repeated rows: each is predicted.  Without labelled texts
every text is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .textbytes import LOWER, U64, chunks

ORDER = 3
UNKNOWN = "und"
#: Labelled texts of each language that the trees are counted on, those with
#: the smallest hashes of their doc_id; all other work covers every row.
ROWS_PER_LANGUAGE = 1500
#: Contexts of full depth seen less often are left to the shorter ones.
LEAST_CONTEXT = 8
#: Numbers (position or context and byte, language) worked on at a time.
BLOCK = 1 << 21
_LETTER = re.compile(r"[^\W\d_]")


class Trees(NamedTuple):
    """Contexts are states, by order: 0, the last byte, two, three.  Kept are
    the bytes seen in a context (by any language), so the size grows with the
    sample's distinct (context, byte) and the languages, not with contexts
    times all bytes."""

    languages: list[str]
    symbol: np.ndarray  # byte -> dense symbol, 0: never seen in the sample
    n_symbols: int
    state: np.ndarray  # three symbols in base n_symbols -> longest context's state
    shorter: np.ndarray  # state -> state of the context one byte shorter
    seen: np.ndarray  # (state, 4) bitmap of the symbols with a row of bits
    first: np.ndarray  # (state, 4) row of the first of them in each word
    escape: np.ndarray  # (state, language) bits before the shorter context's
    bits: np.ndarray  # (row, language)


def sample(docs: DataFrame, learn: F.Column, rows: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """text, lang of the bounded sample: rows for which ``learn`` holds, of
    each language those with the smallest hashes.  The languages are counted
    first, so that only about 1.3 times the sample's texts are shuffled."""
    hashed = F.xxhash64(F.col("doc_id").cast("string"))
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("doc_id", "lang", "text", hashed.alias("_hash"))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))  # a row for each language
    share = (F.col("_hash").cast("double") / 2.0**64 + 0.5) * F.col("_n")
    few = known.join(F.broadcast(counts), "lang").where(share <= 1.3 * rows + 20)
    order = Window.partitionBy("lang").orderBy("_hash", "doc_id", F.xxhash64("text"))
    return few.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= rows).select("lang", "text")


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, gram (ORDER + 1 bytes as a number), n for each batch."""
    for b in batches:
        langs = np.array(b.column(0).to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            seen: dict[int, int] = {}
            for c in chunks(b.column(1).filter(pa.array(langs == lang))):
                codes = _codes(c, LOWER.astype(np.int64), 256)
                for g, n in zip(*(x.tolist() for x in np.unique(codes, return_counts=True)), strict=True):
                    seen[g] = seen.get(g, 0) + n
            yield pa.record_batch([pa.array([lang] * len(seen)), pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["lang", "gram", "n"])


def _codes(c, table: np.ndarray, base: int) -> np.ndarray:  # noqa: ANN001
    """For each byte the number made of it and the ORDER before it; before a
    text stand line feeds."""
    s = table[c.data]
    feed = table[10]
    code = s.copy()
    power = base
    for back in range(1, ORDER + 1):
        before = np.empty_like(s)
        before[back:] = s[: len(s) - back]
        for k in range(back):  # the first bytes of each text
            at = c.starts + k
            before[at[at < c.ends]] = feed
        code += before * power
        power *= base
    return code


def train(examples: DataFrame) -> Trees:
    """Trees of a bounded sample (lang, text); its counts come to the driver,
    at most one for each distinct four bytes of the sample and language."""
    counts = (
        examples.select("lang", "text").mapInArrow(_gram_counts, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    )
    return grow(counts.column("lang").to_pylist(), counts.column("gram").to_numpy(), counts.column("n").to_numpy())


def grow(langs: list[str], grams: np.ndarray, n: np.ndarray) -> Trees:
    languages = sorted(set(langs))
    lang = np.array([languages.index(x) for x in langs], np.int64)
    split = np.stack([(grams >> (8 * k)) & 255 for k in range(ORDER, -1, -1)]).astype(np.int64)  # oldest byte first
    used = np.union1d(np.unique(split), [10])
    symbol = np.zeros(256, np.int64)
    symbol[used] = np.arange(1, len(used) + 1)
    upper = np.arange(65, 91)
    symbol[upper] = symbol[upper + 32]
    size, many = len(used) + 1, max(1, len(languages))
    split = symbol[split]

    of = split[-1]
    codes = [np.zeros(len(grams), np.int64)]  # of order 0 to ORDER: each gram's context
    for k in range(1, ORDER + 1):
        codes.append(split[-1 - k] * size ** (k - 1) + codes[-1])
    held = [np.zeros(1, np.int64), np.arange(size), np.unique(codes[2])]  # every byte has a state
    seen, at = np.unique(codes[3], return_inverse=True)
    held.append(seen[np.bincount(at, weights=n, minlength=len(seen)) >= LEAST_CONTEXT])
    start = np.cumsum([0] + [len(x) for x in held])

    trees = Trees(
        languages, symbol, size, np.zeros(0, np.int32), np.zeros(start[-1], np.int32), np.zeros((start[-1], 4), U64),
        np.zeros((start[-1], 4), np.int64), np.zeros((start[-1], many), np.float32), np.zeros((0, many), np.float32),
    )
    rows, n_rows = [], 0
    exact: list[tuple[np.ndarray, ...]] = []  # of each order: escapes, its pairs' contexts and bytes, their probabilities

    def dense(order: int, contexts: np.ndarray) -> np.ndarray:
        """Probabilities (context, byte, language) of contexts of one order."""
        if order < 0:
            return np.full((len(contexts), size, many), 1 / size)
        escape, where, what, p = exact[order]
        number = np.searchsorted(held[order], contexts)
        out = dense(order - 1, contexts % size ** max(0, order - 1)) * escape[number][:, None, :]
        lo, hi = np.searchsorted(where, number), np.searchsorted(where, number, side="right")
        row = np.repeat(np.arange(len(contexts)), hi - lo)
        pair = np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
        out[row, what[pair]] = p[pair]
        return out

    for order in range(ORDER + 1):
        known = np.isin(codes[order], held[order])
        by = np.argsort(codes[order][known], kind="stable")
        context = np.searchsorted(held[order], codes[order][known][by])
        gram, tongue, count = of[known][by], lang[known][by], n[known][by]
        step = max(1, BLOCK // (size * many))
        parts = []
        for lo in range(0, len(held[order]), step):
            hi = min(len(held[order]), lo + step)
            mine = slice(*np.searchsorted(context, [lo, hi]))
            counts = np.zeros((hi - lo, size, many))
            np.add.at(counts, (context[mine] - lo, gram[mine], tongue[mine]), count[mine])
            shorter = dense(order - 1, held[order][lo:hi] % size ** max(0, order - 1))
            total, kinds = counts.sum(1), (counts > 0).sum(1)
            left = np.where(counts > 0, 0, shorter).sum(1)
            # all bytes seen: nothing to escape to, the counts take it all
            over = np.maximum(total + np.where(left > 0, kinds, 0), 1)
            escape = np.where(total > 0, np.divide(kinds / over, left, out=np.zeros_like(left), where=left > 0), 1.0)
            # kept are the bytes that any language saw here (order 0: all)
            where, what = np.nonzero((counts > 0).any(2) if order else np.ones((1, size), bool))
            some = counts[where, what]
            p = np.where(some > 0, some / over[where], escape[where] * shorter[where, what])
            parts.append((escape, where + lo, what, p))
        if not parts:
            parts = [(np.zeros((0, many)), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, many)))]
        escape, where, what, p = (np.concatenate(x) for x in zip(*parts, strict=True))
        exact.append((escape, where, what, p))
        state = start[order] + where
        np.bitwise_or.at(trees.seen, (state, what >> 6), U64(1) << (what & 63).astype(U64))
        # where a state's rows begin, for each 64 bytes of its bitmap
        kept = np.bitwise_count(trees.seen[start[order] : start[order + 1]]).astype(np.int64)
        trees.first[start[order] : start[order + 1]] = n_rows + (np.cumsum(kept) - kept.ravel()).reshape(-1, 4)
        n_rows += len(where)
        with np.errstate(divide="ignore"):
            trees.escape[start[order] : start[order + 1]] = -np.log2(escape)
            rows.append((-np.log2(p)).astype(np.float32))
        if order:
            cut = held[order] % size ** (order - 1)
            trees.shorter[start[order] : start[order + 1]] = start[order - 1] + np.searchsorted(held[order - 1], cut)

    state = np.tile(start[1] + np.arange(size), size * size).astype(np.int32)  # last byte's state
    by_pair = np.arange(size**3) % (size * size)
    pairs = held[2]
    if len(pairs):
        where = np.minimum(np.searchsorted(pairs, by_pair), len(pairs) - 1)
        hit = pairs[where] == by_pair
        state[hit] = start[2] + where[hit]
    state[held[3]] = start[3] + np.arange(len(held[3]))
    return trees._replace(state=state, bits=np.concatenate(rows))


def _bits(trees: Trees, state: np.ndarray, sym: np.ndarray) -> np.ndarray:
    """Bits (position, language) of bytes in the contexts of those states:
    the kept row, or the escape and then the shorter context's."""
    at = state * np.int64(4) + (sym >> 6)
    word = trees.seen.ravel()[at]
    bit = U64(1) << (sym & 63).astype(U64)
    row = trees.first.ravel()[at] + np.bitwise_count(word & (bit - U64(1)))
    miss = np.flatnonzero((word & bit) == 0)
    row[miss] = 0
    out = trees.bits[row]
    if len(miss):
        out[miss] = trees.escape[state[miss]] + _bits(trees, trees.shorter[state[miss]], sym[miss])
    return out


def code_lengths(trees: Trees, texts: pa.Array) -> np.ndarray:
    """Bits of each text under each language."""
    out = np.zeros((len(texts), len(trees.languages)))
    # positions of a long text are taken some at a time, whatever their number
    step = max(1024, BLOCK // max(1, len(trees.languages)))
    for c in chunks(texts):
        codes = _codes(c, trees.symbol, trees.n_symbols)
        before = np.zeros((1, len(trees.languages)))
        sums = np.zeros((c.hi - c.lo, len(trees.languages)))
        for lo in range(0, len(codes), step):
            # the lowest digit is the byte itself, the rest its context
            context, sym = np.divmod(codes[lo : lo + step], trees.n_symbols)
            so_far = np.concatenate([before, _bits(trees, trees.state[context], sym)])
            np.cumsum(so_far, axis=0, out=so_far)
            for marks, sign in ((c.starts, -1), (c.ends, 1)):
                # a mark at the end of one step is the beginning of the next
                here = np.flatnonzero((marks >= lo) & (marks < lo + len(sym)) | (marks == lo + len(sym)) & (lo + len(sym) == len(codes)))
                sums[here] += sign * so_far[marks[here] - lo]
            before = so_far[-1:]
        out[c.lo : c.hi] = sums
    return out


def predict_batch(trees: Trees, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and bits per byte under it for each text."""
    letters = np.fromiter((t is not None and _LETTER.search(t) is not None for t in texts.to_pylist()), bool, len(texts))
    if not trees.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    bits = code_lengths(trees, texts)
    best = bits.argmin(1)
    least = bits[np.arange(len(best)), best]
    weight = np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
    n_bytes = np.array([len((t or "").encode()) for t in texts.to_pylist()])
    names = [trees.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), letters.tolist(), strict=True)]
    return names, np.where(letters, 1 / weight, 0.0), least / np.maximum(n_bytes, 1)


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """All columns of ``docs`` that are named doc_id or text, and lang_pred,
    score, bits_per_byte; the trees grow with the languages and the bounded
    sample, not with the input."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                names, score, rate = predict_batch(shared.value, part.column(1))
                yield pa.record_batch([part.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(rate)], names=["doc_id", "lang_pred", "score", "bits_per_byte"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, bits_per_byte double")


def with_language(docs: DataFrame, trees: Trees, column: str = "_language") -> DataFrame:
    """``docs`` as it is with a struct ``column`` (lang_pred, score,
    bits_per_byte), whose name must be a new one."""
    if column.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the documents have a column {column!r}")
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                names, score, rate = predict_batch(shared.value, part.column(at))
                found = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score), pa.array(rate)], names=["lang_pred", "score", "bits_per_byte"])
                yield pa.record_batch([*part.columns, found], names=[*part.schema.names, column])

    found = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, found)]))
