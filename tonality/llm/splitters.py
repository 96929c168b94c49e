"""Sharding by sampled splitters (DataFrame functions only).

Rows are ordered by (hash of the text, doc_id), so equal texts stand together.  A sample
in which a row's chance grows with its size gives quantile boundaries; rows are put into
those ranges, the ranges are measured, and a range far over its share (a hot group of
equal texts, or an unlucky draw) is subdivided by boundaries drawn from it alone.  With
the measured ranges, a running sum inside each range yields the exact position of every
row in the whole byte stream, and equal cuts of that stream are the shards.

Law ``bytes``: shard sizes differ from the mean by less than the largest row.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged

SHARDS = 40
#: Bytes a range aims at, and the most ranges (the bounded tables of this operator).
RANGE_BYTES = 4 << 20
MAX_RANGES = 8192
#: Sampled rows expected per range; ranges over this many shares are subdivided.
SAMPLE_PER_RANGE = 32
OVERFULL = 2.0
ROUNDS = 3


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, h, d): what the sharding needs of a row, without its text."""
    raw = docs[text_col].cast("string").cast("binary")
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        (F.coalesce(F.length(raw), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(raw).alias("h"),
        F.coalesce(docs[id_col].cast("long"), F.lit(-(1 << 63))).alias("d"))


def _literal(values: list[int]) -> Column:
    """A constant array (folded by the optimizer), however many values."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def range_of(h: Column, d: Column, splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below the key, by binary search in a constant array."""
    if not splitters:
        return F.lit(0)
    hs, ds = _literal([s[0] for s in splitters]), _literal([s[1] for s in splitters])
    n = len(splitters)
    steps = [1 << k for k in reversed(range(n.bit_length()))]

    def step(at: Column, s: Column) -> Column:
        to = at + s
        sh, sd = F.get(hs, to - 1), F.get(ds, to - 1)
        return F.when((to <= n) & ((h > sh) | ((h == sh) & (d >= sd))), to).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def _draw(rows: DataFrame, per_byte: float, parts_per_byte: float, seed: int) -> list[tuple[int, int]]:
    """Quantile boundaries of a size-weighted sample of ``rows``.

    A row is drawn with chance min(1, size x per_byte) and stands for max(size, 1/per_byte)
    bytes; each ``1/parts_per_byte`` bytes of the sorted sample give one boundary.  The
    sample has about (bytes x per_byte) rows, bounded by MAX_RANGES x SAMPLE_PER_RANGE."""
    u = F.pmod(F.xxhash64("d", "h", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(u < F.col("size") * F.lit(per_byte)).select(
        "h", "d", F.greatest(F.col("size").cast("double"), F.lit(1 / per_byte)).alias("w"))
    before = Window.orderBy("h", "d").rowsBetween(Window.unboundedPreceding, -1)
    part = F.floor(F.coalesce(F.sum("w").over(before), F.lit(0.0)) * F.lit(parts_per_byte))
    cuts = (sample.withColumn("part", part).where("part > 0")
            .groupBy("part").agg(F.min(F.struct("h", "d")).alias("k")).select("k.h", "k.d"))
    return [(r.h, r.d) for r in cuts.collect()]


def shard_rows(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
               range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot): one row per row of ``docs``.

    ``slot`` numbers the rows of a shard from 0 without gaps.  Null texts have size 16 and
    checksum 0; null ids sort first; equal rows are neighbours; other columns stay out.
    An empty table gives an empty result.
    """
    return _placed(docs, shards, id_col, text_col, range_bytes).drop("h", "d")


def _placed(docs: DataFrame, shards: int, id_col: str, text_col: str, range_bytes: int) -> DataFrame:
    """``shard_rows`` with the row key (h, d): equal for rows of equal id and text only."""
    rows = staged(measured(docs, id_col, text_col), "shard-rows")
    total = int(rows.agg(F.sum("size")).first()[0] or 1)
    n_ranges = max(4 * shards, min(MAX_RANGES, math.ceil(total / range_bytes)))
    share = total / n_ranges
    splitters = sorted(set(_draw(rows, SAMPLE_PER_RANGE / share, 1 / share, 1)))
    for again in range(ROUNDS):
        tagged = rows.withColumn("range", range_of(F.col("h"), F.col("d"), splitters))
        sizes = staged(tagged.groupBy("range").agg(  # at most 2 x MAX_RANGES rows
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"),
            F.countDistinct("h", "d").alias("keys") if again else F.lit(2).alias("keys")), "shard-ranges")
        over = [r.range for r in sizes.where(
            (F.col("bytes") > OVERFULL * share) & (F.col("n") > 1) & (F.col("keys") > 1)).collect()]
        if not over or again == ROUNDS - 1:
            break
        dense = 4 * SAMPLE_PER_RANGE / share
        more = _draw(tagged.where(F.col("range").isin(over)), dense, 1 / share, 2 + again)
        more = sorted(set(splitters) | set(more))
        if more == splitters:
            break
        splitters = more
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("range").alias("b_range"),
                         F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base_bytes"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_rows"))
    inside = Window.partitionBy("range").orderBy("h", "d", "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = (tagged.withColumn("upto", F.sum("size").over(upto))
              .withColumn("nth", F.row_number().over(inside))
              .join(F.broadcast(bases), F.col("range") == F.col("b_range")))
    # The middle of a row decides, in whole numbers.
    middle = (F.col("base_bytes") + F.col("upto")) * 2 - F.col("size")
    placed = placed.select(
        "doc_id", "size", "text_crc32", "h", "d",
        F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(2.0 * total))).cast("int").alias("shard"),
        (F.col("base_rows") + F.col("nth") - 1).alias("ordinal"))
    placed = staged(placed, "shard-placed")
    firsts = placed.groupBy("shard").agg(F.min("ordinal").alias("first")).withColumnRenamed("shard", "f_shard")
    return (placed.join(F.broadcast(firsts), F.col("shard") == F.col("f_shard"))  # one row per shard
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("ordinal") - F.col("first")).cast("long").alias("slot"), "h", "d"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Write ``docs`` as one folder per shard (``shard=k``) and return the placement.

    Every row is written once: rows find their place by (id, text hash) and their number
    among rows of equal id and text, which may take each other's places.  Columns of
    ``docs`` named shard or slot are replaced."""
    placed = staged(_placed(docs, shards, id_col, text_col, RANGE_BYTES), "shard-slots")
    keyed = docs.drop("shard", "slot").select(
        "*", F.coalesce(docs[id_col].cast("long"), F.lit(-(1 << 63))).alias("_s_d"),
        F.xxhash64(docs[text_col].cast("string").cast("binary")).alias("_s_h"))
    keyed = keyed.withColumn("_s_n", F.row_number().over(Window.partitionBy("_s_d", "_s_h").orderBy("_s_d")))
    at = placed.select(F.col("d").alias("_s_d"), F.col("h").alias("_s_h"), F.row_number().over(
        Window.partitionBy("d", "h").orderBy("shard", "slot")).alias("_s_n"), "shard", "slot")
    (keyed.join(at.hint("merge"), ["_s_d", "_s_h", "_s_n"]).drop("_s_d", "_s_h", "_s_n")
     .repartition("shard", F.floor(F.col("slot") / 50_000))
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
    return placed.drop("h", "d")


def op9_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 40 shards of nearly equal bytes."""
    placed = shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))
