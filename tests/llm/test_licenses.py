"""Notices with changes, their relatives, and the alignment against Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from abiflow.llm import licenses

TEXT = {label: t for t, label in licenses.NOTICES.items()}


def labels(spark, texts, **kw):
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id int, text string")
    return {r["doc_id"]: r["labels"] for r in licenses.license_scan(docs, **kw).collect()}


def test_each_notice_has_its_own_label(spark):
    names = sorted(TEXT)
    got = labels(spark, [f"Some code. {TEXT[x].upper()}, and so on" for x in names])
    assert [got[k] for k in range(len(names))] == names


def test_words_put_into_a_notice(spark):
    names = sorted(TEXT)
    texts = []
    for x in names:
        w = TEXT[x].split()
        texts.append(" ".join([*w[: len(w) // 2], "alpha", "beta", "gamma", "delta", *w[len(w) // 2 :]]))
    got = labels(spark, texts)
    assert [got[k] for k in range(len(names))] == names


def test_order_counts(spark):
    w = TEXT["bsd"].split()
    thirds = [w[k : k + 3] for k in range(0, len(w), 3)]
    mixed = [x for part in thirds[::-1] for x in part]
    got = labels(spark, [" ".join(mixed), " ".join(w[::-1]), TEXT["bsd"] + " word " + TEXT["isc"], TEXT["mit"] + " " + TEXT["mit"], None, ""])
    assert got == {0: "", 1: "", 2: "bsd,isc", 3: "mit", 4: "", 5: ""}


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_a_table_of_templates(spark, k):
    rng = random.Random(k)
    long = " ".join(f"w{rng.randint(0, 300)}" for _ in range(400))
    other = long.replace("w7", "v7").replace("w1 ", "v1 ")
    templates = spark.createDataFrame([("long", long), ("none", None), ("short", "x"), ("other", other + " and more of it")], "label string, text string")
    changed = long.split()
    for _ in range(20):
        changed[rng.randrange(400)] = "new"
    got = labels(spark, [" ".join(changed), "mit license and cc by", f"before {other} and more of it"], templates=templates, k=k)
    assert got == {0: "long", 1: "cc-by,mit", 2: "other"}


def test_longest_chain_is_the_longest_rising_subsequence(spark):
    rng = random.Random(5)
    rows = [[rng.randrange(12) for _ in range(rng.randint(0, 25))] for _ in range(60)]

    def rising(a):
        best = []
        for j, x in enumerate(a):
            best.append(1 + max((best[i] for i in range(j) if a[i] < x), default=0))
        return max(best, default=0)

    df = spark.createDataFrame([(k, a) for k, a in enumerate(rows)], "k int, a array<int>")
    got = {r["k"]: r["n"] for r in df.select("k", licenses._longest_chain(F.col("a"), F.lit(12)).alias("n")).collect()}
    assert got == {k: rising(a) for k, a in enumerate(rows)}
