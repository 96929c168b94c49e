"""Whitening: the solver against LAPACK, rows against plain numpy, odd vectors, many blocks."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from tonality.llm import whitening as W
from tonality.llm.bidiagonal import bidiagonalise, dqds, right_singular

RNG = np.random.default_rng(5)


def square(m):
    r = np.linalg.qr(np.asarray(m, float), mode="r")
    return np.vstack([r, np.zeros((r.shape[1] - r.shape[0], r.shape[1]))]) if len(r) < r.shape[1] else r


@pytest.mark.parametrize("m", [
    RNG.standard_normal((300, 24)), RNG.standard_normal((300, 24)) * np.logspace(0, -6, 24),
    RNG.standard_normal((50, 4)) @ RNG.standard_normal((4, 12)), RNG.standard_normal((3, 9)), np.eye(7),
    np.zeros((5, 3)), np.vstack([np.eye(6), -np.eye(6)]), np.repeat(RNG.standard_normal((40, 3)), 3, axis=1),
    np.linalg.qr(RNG.standard_normal((60, 20)))[0] * (1 + 1e-10 * np.arange(20)), RNG.standard_normal((8, 1)),
], ids=["random", "graded", "low-rank", "few-rows", "identity", "zero", "paired", "copies", "cluster", "one"])
def test_solver(m):
    r = square(m)
    values, v = right_singular(r)
    s = np.linalg.svd(r, compute_uv=False)
    top = s[0] or 1.0
    assert np.abs(np.sqrt(np.maximum(values, 0)) - s).max() < 1e-13 * top
    assert np.abs(v.T @ v - np.eye(len(s))).max() < 1e-10
    assert np.abs(r.T @ (r @ v) - v * values).max() < 1e-12 * top * top


def test_small_singular_values_keep_their_digits():
    """dqds is accurate relative to each value: a graded bidiagonal against its exact square."""
    a, b = np.array([1.0, 1e-4, 1e-9]), np.array([1e-3, 1e-7])
    got = dqds(a, b)
    from fractions import Fraction as Q
    prod = Q(1)
    for x in a:
        prod *= Q(float(x)) ** 2
    assert math.isclose(float(np.prod(got)), float(prod), rel_tol=1e-13)
    r = np.triu(RNG.standard_normal((6, 6)))
    a, b, v = bidiagonalise(r)
    assert np.allclose(np.sort(dqds(a, b))[::-1], np.linalg.svd(r, compute_uv=False) ** 2, rtol=1e-12)


def brute(vectors, k=32):
    """{row number: (deviation, whitened up to signs)}, explained, by the covariance itself."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    dev = [sum((n * r[i] - s[i]) ** 2 for i in range(d)) for r in x]
    c = np.array([[(n * r[i] - s[i]) / n for i in range(d)] for r in x])
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    return dev, c @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def check(rows, ids, vectors, k=32):
    dev, want, share = brute(vectors, k)
    place = {i: p for p, i in enumerate(ids)}
    got = np.full(want.shape, np.nan)
    for r in rows:
        p = place[r.vec_id]
        assert r.n == len(ids) and r.deviation == dev[p]
        assert math.isclose(r.explained, share[r.component - 1], rel_tol=1e-9)
        assert r.identity_error < 1e-9
        got[p, r.component - 1] = r.whitened
    signs = np.sign((got * want).sum(0))
    assert np.abs(got * signs - want).max() < 1e-7


def test_query(spark, sf):
    t = pq.read_table(f"{sf}/embeddings.parquet").to_pydict()
    fine = [(i, v) for i, v in zip(t["vec_id"], t["embedding"], strict=True)
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    rows = W.op11_whitening(spark, sf).collect()
    assert len(rows) == 32 * len(fine)
    check(rows, [i for i, _ in fine], [v for _, v in fine])


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, n string, vec int, block string")


def whitened(spark, rows, parts=1):
    df = frame(spark, [(i, v, "x", 1, "y") for i, v in rows]).repartition(parts)
    model = W.fit_whitening(W.usable_vectors(df))
    return model, W.whiten(W.usable_vectors(df), model).collect() if model else []


def test_blocks_and_partitions_do_not_matter(spark, monkeypatch):
    rows = [(i, RNG.standard_normal(5).tolist()) for i in range(400)]
    one, a = whitened(spark, rows)
    monkeypatch.setattr(W, "BLOCK", 3)
    monkeypatch.setattr(W, "FAN", 2)
    many, b = whitened(spark, rows, 11)
    assert np.allclose(one.values, many.values, rtol=1e-12) and many.identity_error < 1e-12
    left, right = ({r.vec_id: r for r in x} for x in (a, b))
    for i in left:
        assert left[i].deviation == right[i].deviation
        assert np.allclose(np.abs(left[i].whitened), np.abs(right[i].whitened), atol=1e-9)


def test_odd_rows(spark):
    inf, nan = math.inf, math.nan
    good = [(k, RNG.standard_normal(3).tolist()) for k in range(30)]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, inf, 2.0]), (94, [nan, 1.0, 2.0]),
           (95, [1.0]), (96, [1e30, 0.0, 0.0])]
    model, rows = whitened(spark, good + bad, 3)
    assert model.n == 30 and sorted(r.vec_id for r in rows) == list(range(30))
    repeated = good + [(None, [0.5, 0.5, 0.5])] * 2 + [(3, good[3][1])] * 3
    model, rows = whitened(spark, repeated, 3)
    assert model.n == 35 and len(rows) == 35 and sum(r.vec_id is None for r in rows) == 2
    assert whitened(spark, []) == (None, []) and whitened(spark, bad[:5]) == (None, [])


def test_rank_lost_and_huge_entries(spark):
    flat = [(k, [float(k), 7.0, 2.0 * k]) for k in range(6)]  # a constant and a dependent dimension
    model, rows = whitened(spark, flat)
    assert model.rank == 1 and all(len(r.whitened) == 1 for r in rows)
    model, rows = whitened(spark, [(1, [3.0, 4.0])])
    assert model.rank == 0 and rows[0].deviation == 0 and rows[0].whitened == []
    big = [(k, [float(k % 5) * 2 ** 40, float(k)]) for k in range(50)]
    model, rows = whitened(spark, big)
    dev, _, _ = brute([v for _, v in big], 2)
    assert {r.vec_id: r.deviation for r in rows} == {k: d if d < 2 ** 63 else None for k, d in enumerate(dev)}


def test_empty_table_query(spark, tmp_path):
    spark.createDataFrame([], "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = W.op11_whitening(spark, str(tmp_path))
    assert got.columns[:4] == ["vec_id", "component", "n", "deviation"] and got.collect() == []
