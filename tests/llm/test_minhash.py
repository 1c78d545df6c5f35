"""Near-duplicates by MinHash against exact comparison of all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from abiflow.llm import minhash

from . import brute


def check(docs, n=5, percent=85):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute.classes(rows, n, percent)
    got = minhash.near_duplicates(docs, n, percent).collect()
    key = str
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got), key=key) == sorted(
        ((rows[k][0], size, least, rows[k][0] == least) for k, (size, least, _) in want.items()), key=key
    )


def near_copies(spark, n=150, seed=4):
    """Chains of edited copies, and texts that share a passage."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(150)]
    common = [f"c{k}" for k in range(60)]
    rows = []
    for k in range(n):
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = f"x{rng.randint(0, 10**6)}"
        rows.append((k, " ".join(t)))
        rows.append((n + k, " ".join([f"y{rng.randint(0, 10**6)}" for _ in range(50)] + common)))
    t = list(base[::-1])
    for k in range(60):  # each a near copy of the one before
        t[rng.randrange(len(t))] = f"z{k}"
        t.append(f"end{k}")
        rows.append((5000 - k, " ".join(t)))
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)


def test_small_table(small):
    check(small)


@pytest.mark.parametrize(("n", "percent"), [(5, 85), (3, 90)])
def test_edge_cases(edge, n, percent):
    check(edge, n, percent)


def test_near_copies(spark):
    check(near_copies(spark))


@pytest.mark.parametrize("paired", [2, 32])
def test_large_buckets_and_families_in_blocks(spark, monkeypatch, paired):
    monkeypatch.setattr(minhash, "PAIRED", paired)
    monkeypatch.setattr(minhash, "BLOCK_SETS", 10)
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", 0)
    check(near_copies(spark, 80))


def test_nothing(nothing):
    assert minhash.near_duplicates(nothing).count() == 0
    assert minhash.near_duplicates(nothing).columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    grams = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    for share in (0.5, 0.8, 0.9):
        common = int(3000 * share)
        a, b = np.sort(grams[:common]), np.sort(grams)
        s, t = minhash.signatures([a, b])
        assert abs((s == t).mean() - share) < 0.12
    assert minhash.least_agreement(85) < 0.85 * minhash.BANDS * minhash.ROWS


def test_links_of_blocks_are_those_of_all_pairs():
    rng = random.Random(3)
    texts = []
    for _ in range(12):
        t = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
        for _ in range(8):
            s = list(t)
            for _ in range(rng.randint(0, 3)):
                s[rng.randrange(120)] = "new"
            texts.append(" ".join(s))
    sets = [s for run in minhash.shingles(pa.array(texts), 5) for s in run]
    signed = minhash.signatures(sets)
    want = brute.classes(list(enumerate(texts)), 5, 85)
    for left in (None, np.arange(len(texts)) % 2 == 0):
        u, v = minhash.confirm(sets, signed, left, 85)
        root = list(range(len(texts)))
        for a, b in zip(u.tolist(), v.tolist(), strict=True):
            if left is not None:
                assert left[a] != left[b]
            x, y = root[a], root[b]
            root = [min(x, y) if r in (x, y) else r for r in root]
        if left is None:
            assert [want[k][1] for k in range(len(texts))] == root
