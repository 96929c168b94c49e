"""Distributed ordinals equal row_number on small data."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tonality.plans.ranking import global_ordinal, ordinal_within, top_by_count_candidates


def test_global_ordinal_matches_row_number(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        (F.col("id") * 7919 % 5003).alias("k"), F.col("id"))
    got = {r.id: r.o for r in global_ordinal(df, ["k", "id"], "o", descending=["k"]).collect()}
    w = Window.orderBy(F.col("k").desc(), "id")
    want = {r.id: r.o - 1 for r in df.select("id", F.row_number().over(w).alias("o")).collect()}
    assert got == want
    assert sorted(got.values()) == list(range(5000))


def test_ordinal_within_groups(spark):
    df = spark.range(0, 3000, numPartitions=5).select(
        "id", (F.col("id") % 3).alias("g"), (F.col("id") * 31 % 1009).alias("k"))
    got = {r.id: r.o for r in ordinal_within(df, ["g"], ["k", "id"], "o").collect()}
    w = Window.partitionBy("g").orderBy("k", "id")
    want = {r.id: r.o - 1 for r in df.select("id", F.row_number().over(w).alias("o")).collect()}
    assert got == want


def test_top_by_count_candidates_keeps_exact_top_k(spark):
    rows = [(f"w{i:03d}", c) for i, c in enumerate([9, 7, 7, 7, 5, 5, 3, 1, 1, 1, 1])]
    df = spark.createDataFrame(rows, "word string, n long")
    for k in (1, 2, 4, 5, 7, 11, 50):
        got = global_ordinal(top_by_count_candidates(df, k), ["n", "word"], "r", descending=["n"])
        full = global_ordinal(df, ["n", "word"], "r", descending=["n"])
        assert ({r.word: r.r for r in got.where(F.col("r") < k).collect()}
                == {r.word: r.r for r in full.where(F.col("r") < k).collect()})


def test_positions_survive_a_written_copy_with_other_columns(spark):
    """More rows than any sample, and a column outside the order: written and read back."""
    from tonality.session import fresh_path

    n = 400_000
    df = spark.range(0, n, numPartitions=6).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("k"), "id", F.concat(F.lit("text "), "id").alias("text"),
        (F.col("id") % 3 == 0).cast("int").alias("g"))
    path = fresh_path(spark, "ordinal")
    ordinal_within(global_ordinal(df, ["k", "id"], "o"), ["g"], ["k", "id"], "w").write.parquet(path)
    back = spark.read.parquet(path)
    whole = back.agg(F.count_distinct("o").alias("d"), F.min("o").alias("lo"), F.max("o").alias("hi")).first()
    assert tuple(whole) == (n, 0, n - 1)
    for r in back.groupBy("g").agg(F.count("*").alias("n"), F.count_distinct("w").alias("d"), F.max("w").alias("hi")).collect():
        assert r.n == r.d == r.hi + 1
    out_of_order = back.join(back.select(F.col("o").alias("p"), F.struct("k", "id").alias("before")),
                             F.col("o") == F.col("p") + 1).where(F.struct("k", "id") < F.col("before"))
    assert out_of_order.count() == 0


def test_ordinals_use_no_task_numbers():
    import inspect

    from tonality.plans import ranking

    text = inspect.getsource(ranking)
    assert "spark_partition_id" not in text and "monotonically" not in text


def test_null_and_descending_keys(spark):
    df = spark.createDataFrame([(None, "b"), (3, "a"), (3, None), (1, "z"), (None, None), (7, "q")], "n int, w string")
    got = {(r.n, r.w): r.o for r in global_ordinal(df, ["n", "w"], "o", descending=["n"]).collect()}
    w = Window.orderBy(F.col("n").desc(), "w")
    assert got == {(r.n, r.w): r.o - 1 for r in df.select("n", "w", F.row_number().over(w).alias("o")).collect()}
