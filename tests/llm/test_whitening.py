"""Whitening against numpy's eigenvalues, and its edge cases."""

from __future__ import annotations

import math

import numpy as np
import pytest

from abiflow.llm import whitening
from abiflow.llm.whitening import polar_factor, spectrum, whiten

KIND = "vec_id bigint, embedding array<float>, x string, n int, component string, at int, v string, d int"


def symmetric(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [5.0], [3, 3], [3, 2, 1], [1, 1, 1, 1], [9, 4, 4, 4, 1, 0, 0], [1e6, 1, 1e-3, 1e-9],
        [-3, -1, 0, 2, 2 + 1e-12], list(np.exp(-np.arange(40) / 2)), list(range(64)), [0, 0, 0],
    ],
)
def test_spectrum_of_known_eigenvalues(values):
    a = symmetric(np.array(values, float))
    a = (a + a.T) / 2
    got, v = spectrum(a, len(values))
    scale = max(1e-300, np.abs(values).max())
    assert np.allclose(got, sorted(values, reverse=True), atol=1e-13 * scale * len(values), rtol=0)
    assert np.allclose(v.T @ v, np.eye(len(values)), atol=1e-12)
    assert np.abs(a @ v - v * got).max() <= 1e-13 * scale * len(values)


def test_polar_factor_is_the_sign():
    a = symmetric(np.array([4.0, 1e-8, -1e-3, -7]), 3)
    u = polar_factor((a + a.T) / 2)
    w, q = np.linalg.eigh((a + a.T) / 2)
    assert np.allclose(u, q @ np.diag(np.sign(w)) @ q.T, atol=1e-7)


def test_only_the_largest():
    a = symmetric(np.arange(30.0), 5)
    got, v = spectrum((a + a.T) / 2, 16)
    assert np.allclose(got, np.arange(29, 13, -1)) and v.shape == (30, 16)


def brute(rows, most=16):
    """vec_id -> (deviation, whitened, explained) by numpy, n."""
    good = [(k, v) for k, v in rows if v is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(k, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for k, v in good]
    fit = sorted({tuple(v) for _, v in x})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    z = np.array([[n * a - b for a, b in zip(v, s, strict=True)] for v in fit], float) / n
    w, q = np.linalg.eigh(z.T @ z / n)
    w, q = w[::-1][:most], q[:, ::-1][:, :most]
    out = []
    for k, v in x:
        dev = [n * a - b for a, b in zip(v, s, strict=True)]
        out.append((k, sum(c * c for c in dev), (np.array(dev, float) / n) @ q / np.sqrt(w), w / np.trace(z.T @ z / n)))
    return n, out


def compare(df):
    rows = [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]
    n, want = brute(rows)
    got = whiten(df).toPandas()
    assert len(got) == len(want) * len(want[0][2]) and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    # copies of a vector have equal rows, so ids can be looked up
    by_id = {k: g.sort_values("component") for k, g in got.drop_duplicates(["vec_id", "component"]).groupby("vec_id")}
    sign = None
    for k, deviation, whitened, explained in want:
        g = by_id[k]
        assert set(g["deviation"]) == {deviation}
        assert np.allclose(g["explained"], explained, rtol=1e-9)
        if sign is None:
            sign = np.sign(g["whitened"].values * whitened)
        assert np.allclose(g["whitened"].values * sign, whitened, atol=1e-7)


def test_whitened_rows_of_the_table(spark):
    compare(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))


def test_rows_left_out_and_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(c) for c in rng.normal(size=3)]) for k in range(40)]
    rows += [(k, rows[k % 3][1]) for k in range(100, 160)]
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0]), (203, [1.0, math.nan, 2.0]), (204, [1.0, math.inf, 2.0])]
    df = spark.createDataFrame([(*r, "s", 1, "s", 1, "s", 1) for r in rows], KIND)
    compare(df)
    other = df.unionAll(spark.createDataFrame([(300, [1.0, 2.0], "s", 1, "s", 1, "s", 1), (None, [0.5, 0.5, 0.5], "s", 1, "s", 1, "s", 1)], KIND))
    got = whiten(other)  # another length is left out, a null id stays
    assert got.where("vec_id = 300").count() == 0 and got.where("vec_id is null").count() == 3


def test_no_variance_no_rows_and_large_entries(spark):
    make = lambda rows: spark.createDataFrame([(*r, "s", 1, "s", 1, "s", 1) for r in rows], KIND)
    assert whiten(make([])).count() == 0
    assert whiten(make([(1, None), (2, [])])).count() == 0
    same = whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(same) == 4 and {(r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in same} == {(1, 0, None, None)}
    flat = whiten(make([(k, [float(k), 7.0]) for k in range(9)])).collect()
    assert {r["component"]: r["whitened"] is None for r in flat} == {1: False, 2: True}
    huge = whiten(make([(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 0.5])])).collect()
    assert len(huge) == 6 and any(r["deviation"] is None for r in huge)


def test_wide_integers_stay_exact():
    y = np.array([[1 << 45, 3], [-(1 << 45), 5], [7, 1 << 44]], np.int64)
    want = [[sum(int(a[i]) * int(a[j]) for a in y) for j in range(2)] for i in range(2)]
    assert whitening._products(y).tolist() == want
