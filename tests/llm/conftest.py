"""Small tables with the cases every operator must settle."""

from __future__ import annotations

import random

import pytest

SMALL = "/root/testdata/sf0.001"

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, shard int, fp string, key string, h int, w int, n int, grams string, label string"


def _prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choices(["an", "the", "or", "ti", "on", "es", "ing", "re"], k=rng.randint(1, 4))) for _ in range(60)]
    return " ".join(rng.choice(words) for _ in range(n))


def edge_rows() -> list[tuple]:
    same = _prose(1, 80)
    texts = [
        (0, None, "en"), (1, "", "en"), (2, "   \n\t ", None), (3, same, "en"), (4, same, "en"), (5, same + " end", None),
        (6, _prose(2, 30_000), "en"), (7, "a", "de"), (8, "Über die Straße, ÄÖÜ! ß", "de"), (9, "12 34 -- ##", "en"),
        (10, "\u0000x\u0001 y\u0002", "en"), (11, "😀 emoji 😀 text 😀", "en"), (12, same.upper(), "en"), (12, same.upper(), "en"),
        (13, "x" * 50_000, "en"), (14, "word " * 5_000, "en"), (None, "no id here at all", "en"), (None, None, None), (15, same, None),
    ]
    return [(d, t, lang, None if d == 4 else f"src{(d or 0) % 3}", None, 9, 9, "x", "x", 9, 9, 9, "x", "x") for d, t, lang in texts]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
