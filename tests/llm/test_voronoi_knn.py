"""Voronoi kNN join against brute force and DuckDB; pruning; odd rows."""

import math

import numpy as np
import pytest

from tonality.llm import voronoi_knn as V

from .duck import same_as_duckdb


def brute(rows, k=5, every=50):
    ok = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
          if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out, done = [], set()
    for i, q in ok:
        if i % every or (i, tuple(q)) in done:
            continue
        done.add((i, tuple(q)))
        s = sorted((-sum(a * b for a, b in zip(q, x, strict=False)), j) for j, x in ok if j != i)
        out += [(i, r + 1, j, -t) for r, (t, j) in enumerate(s[:k])]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(v, i, 1) for i, v in rows], "embedding array<double>, vec_id bigint, cell int")
    return sorted(tuple(r) for r in V.knn_join(df, **kw).collect())


def test_query_equals_duckdb(spark, sf):
    got = same_as_duckdb(V.op3_voronoi_knn(spark, sf), V.SQL, sf)
    assert len(got) == 50


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_random_against_brute_force(spark, spread):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8)) * 3
    rows = [(i, (centres[i % 6] + spread * rng.normal(size=8)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(30)]  # ties
    assert run(spark, rows, is_query="vec_id % 10 = 0", pivots=6, query_block=5, salt_rows=60) == brute(rows, every=10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [0.5, -1.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]),
            (5, [1.0]), (6, []), (7, [1.0, 1.0, 9.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]),
            (50, [0.5, -1.0]), (100, None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    big = [(0, [1e9, 3.0]), (1, [1e9, 5.0]), (2, [-1e9, 1.0])]
    assert [r[2] for r in run(spark, [(i, [c / 256 for c in v]) for i, v in big])] == [1, 2]


def test_products_beyond_doubles_are_exact():
    import numpy as np

    big = float((1 << 29) + 2)
    q, x = np.array([[big, 1.0]]), np.array([[big * 2, 1.0], [big * 2, 2.0]])
    assert V._products(q, x).tolist() == [[int(big) * int(big) * 2 + 1, int(big) * int(big) * 2 + 2]]
    far = np.array([[2.0 ** 40]])
    assert V._products(far, np.array([[2.0 ** 40], [-2.0 ** 40]])).tolist() == [[2 ** 63 - 1, -(2 ** 63)]]
