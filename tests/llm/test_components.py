"""Connected components against union-find."""

import random

from tonality.llm.components import components, merged


def union_find(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        up[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in up}


def run(spark, edges):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    return {r.node: r.root for r in components(df).collect()}


def test_random_paths_and_stars(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)]
    edges = [(a, b) for a, b in edges if a != b]
    path = list(range(1000, 1060))
    rnd.shuffle(path)
    edges += list(zip(path, path[1:], strict=False)) + [(2000 + k, 2500) for k in range(100)]
    assert run(spark, edges + edges[:20]) == union_find(edges)


def test_merged_in_steps(spark):
    rnd = random.Random(6)
    parts = [[(rnd.randrange(-90, 90), rnd.randrange(90)) for _ in range(30)] for _ in range(3)]
    parts = [[(a, b) for a, b in p if a != b] for p in parts]
    labels = None
    for p in parts:
        labels = merged(labels, spark.createDataFrame(p, "a bigint, b bigint"))
    assert {r.node: r.root for r in labels.collect()} == union_find([e for p in parts for e in p])


def test_odd_edges(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, 1), (None, 2), (2, None)]) == {}
