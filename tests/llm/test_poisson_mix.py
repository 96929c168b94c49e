"""Poisson mixing: DuckDB parity, the distribution itself, order and odd rows."""

import hashlib
import math

from pyspark.sql import functions as F

from tonality.llm import poisson_mix as P

from .duck import same_as_duckdb


def py_count(doc_id, rate, seed=P.SEED):
    parts, n = max(1, math.ceil(rate / P.PART_RATE)), 0
    for part in range(1, parts + 1):
        h = hashlib.md5(f"{seed}:{doc_id}:{part}".encode()).hexdigest()[:13]
        u, p = (int(h, 16) + 0.5) / (1 << 52), math.exp(-rate / parts)
        k, c = 0, p
        while c < u and k < 400:
            k += 1
            p *= rate / parts / k
            c += p
        n += k
    return n


def test_query_equals_duckdb(spark, sf):
    assert same_as_duckdb(P.op8_poisson_mix(spark, sf), P.SQL, sf)


def test_targets_and_rates(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b", i) for i in range(3000)],
                               "doc_id bigint, source string, copy int")
    want = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("zz", 9.0)], "source string, weight double")
    got = P.poisson_mix(df, targets=want, total=90_000)
    rows = got.groupBy("doc_id", "source").agg(F.count("*").alias("n"), F.first("rate").alias("rate"),
                                               F.max("copy").alias("top")).collect()
    by = {s: sum(r.n for r in rows if r.source == s) for s in "ab"}
    assert abs(by["b"] / (by["a"] + by["b"]) - 0.75) < 0.02
    assert abs(sum(by.values()) - 90_000) < 1500
    rate = {r.source: r.rate for r in rows}
    assert math.isclose(rate["b"], 67.5) and math.isclose(rate["a"], 11.25)
    assert all(r.n == r.top == py_count(r.doc_id, r.rate) for r in rows)


def test_partitioning_does_not_matter_and_order_is_shuffled(spark):
    df = spark.createDataFrame([(i, f"s{i % 2}") for i in range(500)], "doc_id bigint, source string")
    a = [tuple(r) for r in P.poisson_mix(df.repartition(7)).collect()]
    b = [tuple(r) for r in P.poisson_mix(df.coalesce(1)).collect()]
    assert sorted(a) == sorted(b)
    ids = [r[0] for r in a]
    assert ids != sorted(ids)


def test_many_sources_are_joined_by_salt(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"s{i % 5}") for i in range(300)], "doc_id bigint, source string")
    want = sorted(tuple(r) for r in P.poisson_mix(df).collect())
    monkeypatch.setattr(P, "BROADCAST_SOURCES", 2)
    assert sorted(tuple(r) for r in P.poisson_mix(df).collect()) == want


def test_odd_rows(spark):
    schema = "doc_id bigint, source string, rate string, row int, id int, u int, n int, cdf int"
    df = spark.createDataFrame([(None, None, "q", 1, 2, 3, 4, 5), (1, None, "q", 1, 2, 3, 4, 5)] * 40, schema)
    got = P.poisson_mix(df, total=400)
    assert got.columns == ["doc_id", "source", "row", "id", "u", "n", "cdf", "copy", "rate", "shuffle_key"]
    rows = got.collect()
    assert {r.rate for r in rows} == {5.0} and {r.row for r in rows} == {1}
    assert P.poisson_mix(df.where("false")).collect() == []
    zero = spark.createDataFrame([("none", 1.0)], "source string, weight double")
    assert P.poisson_mix(df, targets=zero).collect() == []


def test_plan_is_native(spark, sf):
    plan = P.op8_poisson_mix(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_null_and_repeated_ids_draw_apart(spark):
    """Half of the rows without an id, some ids repeated, some rows wholly equal."""
    rows = [(None if i % 2 else i, "s", f"text {i}") for i in range(20_000)]
    rows += [(7, "s", f"again {i}") for i in range(2_000)] + [(None, "s", "the same")] * 2_000
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    total = None
    for parts in (3, 8):
        got = P.poisson_mix(df.repartition(parts)).cache()
        by = {r.kind: r.n for r in got.groupBy(F.expr(
            "CASE WHEN text = 'the same' THEN 'same' WHEN text LIKE 'again%' THEN 'again' WHEN doc_id IS NULL THEN 'null' "
            "ELSE 'id' END").alias("kind")).agg(F.count("*").alias("n")).collect()}
        for kind, n in (("null", 10_000), ("id", 10_000), ("again", 2_000), ("same", 2_000)):
            assert abs(by[kind] - n) < 4 * n ** 0.5
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * sum(sizes) / len(sizes)
        total = got.count() if total is None else total
        assert got.count() == total  # the draws do not follow the partitions
        got.unpersist()
