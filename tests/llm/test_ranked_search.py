"""Ranked search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from abiflow.llm import ranked_search as R

from . import brute

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(brute.LOWER))


def ranking(docs, items, keep=50):
    """(item_id, rank, doc_id, score) for (id, text) rows."""
    each = [(d, Counter(terms(t))) for d, t in docs]
    each = [(d, c) for d, c in each if c]
    n_docs, n_terms = len(each), sum(sum(c.values()) for _, c in each)
    df = Counter(t for _, c in each for t in c)
    out = []
    for item, text in items:
        rows = []
        for d, c in each:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(rows)[:keep])]
    return sorted(out, key=str)


def check(spark, docs, items, keep=50):
    a = [(r["doc_id"], r["text"]) for r in docs.collect()]
    b = [(r["item_id"], r["text"]) for r in items.collect()]
    got = R.ranked_search(docs, items, keep).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == ranking(a, b, keep)


def test_whole_small_table(spark, small):
    check(spark, small, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))


ITEMS = "item_id string, text string, doc_id int, rank int, score string, item_row int, n int"


def items_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, "x", 7, 7) for r in rows], ITEMS)


def test_edge_cases(spark, edge, nothing):
    items = items_of(spark, [("a", "word and text"), ("b", None), ("c", " .,;"), ("d", "ÜBER über Straße 12"), ("e", "nowhere-at-all"), (None, "id id the"), ("a", "word and text")])
    a = [(r["doc_id"], r["text"]) for r in edge.collect()]
    got = R.ranked_search(edge, items).collect()
    # both rows of a repeated item have their ranking
    assert len({r["item_row"] for r in got if r["item_id"] == "a"}) == 2
    pairs = {(r["item_row"], r["rank"]) for r in got}
    assert len(pairs) == len(got)
    want = ranking(a, [(r["item_id"], r["text"]) for r in items.collect()])
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == want
    assert R.ranked_search(nothing, items).count() == 0
    assert R.ranked_search(edge, items.where("false")).count() == 0
    assert R.ranked_search(edge, items.where("text is null")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_ties_blocks_and_groups(spark, monkeypatch, seed):
    """Many equal scores, small blocks and steps, several groups of items."""
    monkeypatch.setattr(R, "BLOCK_MOST", 16)
    monkeypatch.setattr(R, "FIRST_STEP", 2)
    monkeypatch.setattr(R, "ITEMS", 4)
    rng = random.Random(seed)
    vocabulary = [f"t{k}" for k in range(40)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([3, 3, 3, 8, 30]))) for _ in range(60)]
    docs = spark.createDataFrame([(k, rng.choice(texts)) for k in range(400)], "doc_id bigint, text string").repartition(3)
    items = items_of(spark, [(f"i{k}", " ".join(rng.choices([*vocabulary, "absent"], k=rng.randint(1, 9)))) for k in range(9)])
    check(spark, docs, items, keep=7)


def test_reading_stops_early_and_strictly_below():
    """A term's list is not read to its end, but equal scores are found."""
    n = 5000
    doc = np.arange(n)
    impact = np.where(doc < 40, 900, 10)
    block = R.Block(1, n, np.zeros(n, np.int64), doc, impact)
    docs, scores, read = block.search(np.array([0]), 10, 0)
    assert set(scores) == {900} and set(docs) == set(range(40)) and read < 200
    docs, scores, read = block.search(np.array([0]), 10, 901)
    assert not len(docs) and read <= R.FIRST_STEP
    docs, _, _ = block.search(np.array([0]), 10, 900)
    assert len(docs) == 40  # equal to the last kept score: still wanted


def test_direct_accesses_move_the_best_position():
    """Places seen by direct access count: both lists hold the same documents
    in opposite orders, so half of each meets them all."""
    doc = np.concatenate([np.arange(64), np.arange(64)])
    at = np.repeat([0, 1], 64)
    impact = np.concatenate([np.arange(64, 0, -1) + 100, np.arange(64) + 100])
    block = R.Block(2, 64, at, doc, impact)
    docs, scores, read = block.search(np.array([0, 1]), 64, 0)
    assert len(docs) == 64 and scores.sum() == impact.sum()
    assert read == 64  # of 128 places
