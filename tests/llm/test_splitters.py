"""Sampled splitters: gapless slots, near-equal bytes, hot groups, odd rows."""

import random
import zlib
from collections import defaultdict

from tonality.llm import splitters as S
from tonality.session import fresh_path


def check(rows, texts, shards):
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (i is not None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    slots, sizes = defaultdict(list), dict.fromkeys(range(shards), 0)
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    largest, mean = max((r.size for r in rows), default=0), sum(sizes.values()) / shards
    assert all(abs(n - mean) <= largest + 1 for n in sizes.values())


def run(spark, texts, shards=8, **kw):
    df = spark.createDataFrame([(t, i, "x", 0) for i, t in texts],
                               "text string, doc_id bigint, shard string, size int")
    return S.shard_rows(df, shards, **kw).collect()


def test_sizes_are_near_equal(spark):
    rnd = random.Random(1)
    texts = [(i, "é" * rnd.randrange(1, 400) + str(i)) for i in range(3000)]
    texts += [(5000, "long " * 4000)]
    rows = run(spark, texts, range_bytes=8 << 10)
    check(rows, texts, 8)
    assert {r.law for r in rows} == {"bytes"}


def test_hot_group_is_subdivided(spark):
    texts = [(i, "the same text of a hot group" * 5) for i in range(2000)] + [(9000 + i, f"t{i}" * 20) for i in range(2000)]
    check(run(spark, texts, range_bytes=2 << 10), texts, 8)


def test_equal_texts_stand_together(spark):
    texts = [(i, f"group {i % 50} " * 10) for i in range(2000)]
    rows = run(spark, texts)
    homes = defaultdict(set)
    for r in rows:
        homes[r.text_crc32].add(r.shard)
    assert sum(len(h) for h in homes.values()) <= 50 + 7


def test_odd_rows(spark):
    texts = [(None, None), (None, ""), (1, None), (1, "a"), (1, "a"), (2, "x" * 100_000)] + [(7, "same")] * 500
    check(run(spark, texts), texts, 8)
    assert run(spark, []) == []


def test_query(spark, sf):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = S.op9_splitters(spark, sf)
    rows = got.collect()
    check(rows, texts, 40)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_written_shards(spark):
    df = spark.createDataFrame([(i, f"text {i}" * 9) for i in range(400)], "doc_id bigint, text string")
    path = fresh_path(spark, "t-shards")
    placed = S.write_shards(df, path, 5)
    back = spark.read.parquet(path)
    assert sorted((r.doc_id, r.shard) for r in back.collect()) == sorted((r.doc_id, r.shard) for r in placed.collect())
    assert back.count() == 400


def test_written_shards_hold_every_row_once(spark):
    """Repeated ids, null ids, equal rows and rows that differ in another column only."""
    rows = [(1, "a", 0), (1, "a", 1), (1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "n", 4), (None, "n", 4), (None, None, 5),
            (3, None, 6)] + [(9, "hot", k) for k in range(60)]
    df = spark.createDataFrame([(t, i, x, 8) for i, t, x in rows], "text string, doc_id bigint, x int, shard int")
    path = fresh_path(spark, "written-shards")
    placed = S.write_shards(df, path, 4)
    back = spark.read.parquet(path).collect()
    key = lambda r: tuple((v is not None, v) if not isinstance(v, bool) else v for v in r)
    assert sorted(((r.doc_id, r.text, r.x) for r in back), key=key) == sorted(rows, key=key)
    assert sorted((r.shard, r.slot) for r in back) == sorted((r.shard, r.slot) for r in placed.collect())
