"""Ranked lexical search by best positions in impact lists.

An item's score for a document is the sum, over the item's distinct terms,
of the term's impact there: ``w * ((10**9 * tf) div (1000 * tf + 20 * m))``
with ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and
``m = 50 + ((50 * n * N) div L)``; N documents hold a term at all, L is the
number of all their terms, n a document's, df the documents with this term.

1. One pass over the texts writes each document's counts of the items' terms
   (terms are compared by 64-bit hashes); N, L and df are sums over it.
2. Documents are searched in blocks.  A block holds, for each term, a list of
   its documents by falling impact, and the place of every document in it.
   The lists of an item are read downwards together; a document met for the
   first time is looked up in all of the item's lists directly, which also
   marks its place in each as seen.  The best position of a list is the last
   one before its first unseen place: no document that is still unseen has
   more there than the entry at that position (nothing, once a whole list is
   seen).  Reading stops when these entries add up to strictly less than the
   item's last kept score, so equal scores are all found.
3. A task keeps the best rows of each item over all its blocks, and the last
   of them bounds the next block from its start; the tasks' best rows are
   ranked by item.

Items are taken in groups of about ``ITEMS`` and ``ITEM_CHARS``, whose terms
are what each task is given.  Only ``A-Z`` are lower-cased; null or empty texts have no
terms.  Equal scores: ascending doc_id (null last), then the row.  Repeated
rows and items: each row is ranked, each item row gets its ranking (by its
own ``item_row``).  Items without terms, or whose terms no document holds,
and empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import numbered, scratch
from .textbytes import LOWER, chunks, hash_spans, spans, table

KEEP = 50
#: Items, and characters of theirs, that are searched at a time; their terms
#: are given to every task.
ITEMS = 2_000
ITEM_CHARS = 500_000
#: Entries of a block's table of places (terms x documents, 4 bytes each).
PLACES = 1 << 24
BLOCK_MOST = 1 << 14
#: Places of each list that are read before the first stop test; each later
#: step reads twice as many.
FIRST_STEP = 32

#: Not in a term: marks and controls of ASCII.
BETWEEN = table("\x00/") | table(":@") | table("[`") | table("{\x7f")


class Items(NamedTuple):
    """A group of items: sorted hashes of their terms, and each item's terms
    as places among them."""

    rows: np.ndarray  # item_row of each item
    terms: np.ndarray  # uint64, sorted
    of: list[np.ndarray]


# --- terms ------------------------------------------------------------------


def term_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(position in the batch, hashes of its terms in turn) of every text."""
    for c in chunks(texts):
        data = LOWER[c.data]
        starts, ends, first = spans(c, BETWEEN)
        hashes = hash_spans(data, starts, ends)
        for k in range(c.hi - c.lo):
            yield c.lo + k, hashes[first[k] : first[k + 1]]


def read_items(items: DataFrame) -> Items:
    """``items`` (item_row, text) of one group, at most about ``ITEMS``."""
    got = items.select("item_row", "text").toArrow()
    rows = got.column(0).to_numpy()
    texts = got.column(1).combine_chunks() if got.num_rows else pa.array([], pa.string())
    each = [np.unique(h) for _, h in term_hashes(texts)]
    terms = np.unique(np.concatenate(each)) if each else np.zeros(0, np.uint64)
    return Items(rows, terms, [np.searchsorted(terms, h).astype(np.int32) for h in each])


def term_counts(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """doc_id, n (terms of the text), at and tf (those of ``terms`` that it
    holds, as places among them, and how often) of texts with any term."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            row, size, at, tf = [], [], [], []
            for k, hashes in term_hashes(b.column(1)):
                if not len(hashes):
                    continue
                place = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
                place = place[known[place] == hashes] if len(known) else place[:0]
                held, often = np.unique(place, return_counts=True)
                row.append(k)
                size.append(len(hashes))
                at.append(held.astype(np.int32))
                tf.append(often.astype(np.int64))
            cut = pa.array(np.cumsum([0, *map(len, at)]).astype(np.int32))
            flat = lambda parts, t: pa.ListArray.from_arrays(cut, pa.array(np.concatenate(parts) if parts else np.zeros(0, t)))  # noqa: E731, B023
            yield pa.record_batch(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(size, pa.int64()), flat(at, np.int32), flat(tf, np.int64)],
                names=["doc_id", "n", "at", "tf"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n bigint, at array<int>, tf array<bigint>")


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """The terms' weights from the numbers of documents that hold them."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], dtype=np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, w: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 100 - 50 + 50 * n * n_docs // n_terms
    return w * (1_000_000_000 * tf // (1000 * tf + 20 * m))


# --- one block --------------------------------------------------------------


class Block:
    """Impact lists of some documents: ``doc`` and ``impact`` in order of
    term and falling impact (equal ones by document), ``first`` where each
    term's list begins, ``place`` of (term, document) in its list or -1."""

    def __init__(self, terms: int, documents: int, at: np.ndarray, doc: np.ndarray, impact: np.ndarray) -> None:
        order = np.lexsort((doc, -impact, at))
        self.doc, self.impact = doc[order], impact[order]
        at = at[order]
        self.first = np.searchsorted(at, np.arange(terms + 1))
        self.place = np.full((terms, documents), -1, np.int32)
        self.place[at, self.doc] = np.arange(len(at)) - self.first[at]

    def lists(self, terms: np.ndarray) -> list[tuple[int, int, int]]:
        """(term, begin, end) of the lists that hold any impact."""
        cut = [(int(t), int(self.first[t]), int(self.first[t + 1])) for t in terms]
        return [(t, a, b) for t, a, b in cut if b > a and self.impact[a] > 0]

    def search(self, terms: np.ndarray, keep: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents with scores above 0 that can be among the best ``keep``
        if ``least`` is the last score kept so far (0: fewer are), their
        scores, and the places read."""
        lists = self.lists(terms)
        if not lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        begin = np.array([a for _, a, _ in lists])
        length = np.array([b - a for _, a, b in lists])
        rows = np.array([t for t, _, _ in lists])
        met = np.zeros(self.place.shape[1], bool)
        seen = [np.zeros(n + 1, bool) for n in length]  # the last is never seen
        best = np.zeros(len(lists), np.int64)  # best position + 1
        found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        low, step = 0, FIRST_STEP
        while True:
            high = low + step
            new = np.unique(np.concatenate([self.doc[a + low : a + min(high, n)] for a, n in zip(begin, length, strict=True) if low < n]))
            new = new[~met[new]]
            met[new] = True
            places = self.place[rows[:, None], new]  # direct accesses
            held = places >= 0
            got = np.where(held, self.impact[np.where(held, places, 0) + begin[:, None]], 0).sum(0)
            for k in range(len(lists)):
                seen[k][places[k][held[k]]] = True
                best[k] += int(np.argmin(seen[k][best[k] :]))  # to the first unseen place
            found.append(new)
            scores.append(got)
            whole = np.concatenate(scores)
            bound = least
            if len(whole) >= keep:
                bound = max(bound, int(np.partition(whole, len(whole) - keep)[len(whole) - keep]))
            # what an unseen document can have in each list at most
            left = np.where(best < length, self.impact[begin + np.maximum(best, 1) - 1], 0).sum()
            if left < bound or not left:
                break
            low, step = high, step * 2
        docs = np.concatenate(found)
        good = (whole > 0) & (whole >= bound)
        return docs[good], whole[good], int(np.minimum(high, length).sum())


# --- whole tables -----------------------------------------------------------


def _search(counts: DataFrame, items: Items, w: np.ndarray, n_docs: int, n_terms: int, keep: int) -> DataFrame:
    """item_row, doc_id, score, read: the best rows of each task and item."""
    shared = counts.sparkSession.sparkContext.broadcast((items, w))
    kind = counts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, weight = shared.value
        size = max(16, min(BLOCK_MOST, PLACES // max(1, len(group.terms))))
        # of each item: scores and rows (places in ids) of the best so far
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in group.of]
        read = np.zeros(len(group.of), np.int64)
        ids = None

        def block(b: pa.RecordBatch) -> None:
            nonlocal ids, best
            cut = b.column(2).offsets.to_numpy()
            doc = np.repeat(np.arange(b.num_rows), np.diff(cut))
            at = b.column(2).values.to_numpy()[cut[0] : cut[-1]]
            cut = b.column(3).offsets.to_numpy()
            tf = b.column(3).values.to_numpy()[cut[0] : cut[-1]]
            impact = impacts(tf, b.column(1).to_numpy()[doc], weight[at], n_docs, n_terms)
            lists = Block(len(group.terms), b.num_rows, at, doc, impact)
            old = 0 if ids is None else len(ids)
            both = b.column(0) if ids is None else pa.concat_arrays([ids, b.column(0)])
            by_id = np.empty(len(both), np.int64)  # order of equal scores
            by_id[pc.sort_indices(both, null_placement="at_end").to_numpy()] = np.arange(len(both))
            for k, terms in enumerate(group.of):
                have, rows = best[k]
                docs, scores, places = lists.search(terms, keep, int(have[-1]) if len(have) >= keep else 0)
                read[k] += places
                have, rows = np.concatenate([have, scores]), np.concatenate([rows, docs + old])
                order = np.lexsort((by_id[rows], -have))[:keep]
                best[k] = have[order], rows[order]
            # only the ids that an item still holds are kept
            used = np.unique(np.concatenate([r for _, r in best])) if best else np.zeros(0, np.int64)
            best = [(s, np.searchsorted(used, r)) for s, r in best]
            ids = both.take(pa.array(used))

        for b in batches:
            for lo in range(0, b.num_rows, size):
                block(pa.concat_batches([b.slice(lo, size)]))
        if ids is not None:
            of = np.repeat(np.arange(len(best)), [len(s) for s, _ in best])
            yield pa.record_batch(
                [pa.array(group.rows[of], pa.int64()), ids.take(pa.array(np.concatenate([r for _, r in best]) if best else [], pa.int64())),
                 pa.array(np.concatenate([s for s, _ in best]) if best else [], pa.int64()), pa.array(read[of], pa.int64())],
                names=["item_row", "doc_id", "score", "read"],
            )

    return counts.mapInArrow(run, f"item_row bigint, doc_id {kind}, score bigint, read bigint")


def _group(docs: DataFrame, items: DataFrame, keep: int) -> DataFrame:
    spark = docs.sparkSession
    group = read_items(items)
    path = scratch(spark, "terms")
    term_counts(docs, group.terms).write.parquet(path)
    counts = spark.read.parquet(path)
    all_ = counts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    df = np.zeros(len(group.terms), np.int64)
    # one row for each term of the group
    for r in counts.select(F.explode("at").alias("at")).groupBy("at").count().collect():
        df[r["at"]] = r["count"]
    found = _search(counts, group, weights(df, all_["n"]), all_["n"], max(all_["l"], 1), keep)
    order = Window.partitionBy("item_row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def ranked_search(docs: DataFrame, items: DataFrame, keep: int = KEEP, item_id: str = "item_id") -> DataFrame:
    """item_row, item_id, rank, doc_id, score, read (places of the lists that
    the row's task read for the item) of each item's best documents."""
    spark = docs.sparkSession
    rows = numbered(items.select(F.col(item_id).alias("item_id"), "text"), "item_row").where(F.col("text").isNotNull())
    size = rows.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    groups = max(-(-size["items"] // ITEMS), -(-size["chars"] // ITEM_CHARS))
    if not groups:
        kinds = [docs.schema["doc_id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()]
        return spark.createDataFrame([], f"item_row bigint, item_id {kinds[1]}, rank int, doc_id {kinds[0]}, score bigint, read bigint")
    dealt = F.pmod(F.xxhash64("item_row"), F.lit(groups))
    found = reduce(DataFrame.unionAll, [_group(docs, rows.where(dealt == k), keep) for k in range(groups)])
    return found.join(rows.select("item_row", "item_id"), "item_row").select("item_row", "item_id", "rank", "doc_id", "score", "read")
