"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Each source gets a mean repetition rate: (target share x wanted total) / rows of the
source.  Every document draws its number of copies by inverting the Poisson distribution
of its source's rate at a uniform number hashed from (seed, doc_id), is exploded by that
count, and all copies are shuffled globally by a hash of (seed, doc_id, copy).

No draw depends on another row, so the result does not change with partitioning, task
retries or the order of the input; a hot source is only more rows of the same scan.  Rows
whose id is null or occurs more than once draw by (id, hash of the row, number among equal
rows): each has a draw and a place of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ID_BROADCAST_BYTES, staged

#: Rates above this are drawn as a sum of equal parts (a sum of Poisson draws is Poisson).
PART_RATE = 16.0
#: Sources up to this many are broadcast (one row of at most a few hundred numbers each).
BROADCAST_SOURCES = 20_000
#: Beyond it, the rows of a source are spread over so many salts for the join.
SALTS = 64
SEED = 20_240_601


def hashed52(*parts: Column) -> Column:
    """52-bit integer from md5 of the parts joined by ':'."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13), 16, 10).cast("long")


def uniform(*parts: Column) -> Column:
    return (hashed52(*parts) + F.lit(0.5)) / F.lit(float(1 << 52))


def poisson_cdf(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... far enough that no 52-bit uniform number lies beyond."""
    far = F.ceil(rate + F.lit(12.0) * F.sqrt(rate) + F.lit(24.0)).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(
            acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), far), start, step, lambda acc: acc["cdf"])


def source_rates(docs: DataFrame, source_col: str = "source", targets: DataFrame | None = None,
                 total: int | None = None, temperature: float = 0.5) -> DataFrame:
    """(source, n, rate): one row per source, null being a source of its own.

    ``targets`` (source, weight): wanted shares, normalised over the sources that occur;
    a source without a target gets none.  Without targets a source's weight is its row
    count to the power ``temperature``.  ``total``: wanted rows (default: as many as now).
    """
    sizes = docs.groupBy(docs[source_col].alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if targets is None:
        weighed = sizes.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(float(temperature))))
    else:
        want = (targets.groupBy(F.col("source").alias("t_source"))
                .agg(F.sum(F.col("weight").cast("double")).alias("w")))
        weighed = sizes.join(want, sizes.source.eqNullSafe(want.t_source), "left").drop("t_source")
        weighed = weighed.withColumn("w", F.greatest(F.coalesce("w", F.lit(0.0)), F.lit(0.0)))
    weighed = staged(weighed, "mix-sources")
    sums = weighed.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    all_w, rows = sums["w"] or 1.0, sums["n"] or 0
    wanted = float(rows if total is None else total)
    return weighed.select("source", "n", (F.col("w") * F.lit(wanted) / F.lit(float(all_w))
                                          / F.col("n")).alias("rate"))


def _own_draws(rows: DataFrame) -> DataFrame:
    """``rows`` with an ``id`` for every row: its own where that is unique, else the id with
    the hash of the row and its number among equal rows.  Only such rows are shuffled."""
    counts = rows.groupBy("id").agg(F.count(F.lit(1)).alias("k"))
    shared = staged(counts.where("k > 1 OR id IS NULL").select(F.col("id").alias("s_id")), "mix-shared-ids")
    n = shared.count()
    if not n:
        return rows
    few = F.broadcast(shared) if n * 64 <= ID_BROADCAST_BYTES else shared.hint("merge")
    same = rows.id.eqNullSafe(F.col("s_id"))
    odd = rows.join(few, same, "left_semi").withColumn("h", F.xxhash64("row"))
    nth = F.row_number().over(Window.partitionBy("id", "h").orderBy("h"))
    odd = odd.withColumn("id", F.concat_ws("|", F.coalesce("id", F.lit("null")), F.col("h").cast("string"),
                                           nth.cast("string"))).drop("h")
    return rows.join(few, same, "left_anti").unionByName(odd)


def poisson_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                targets: DataFrame | None = None, total: int | None = None,
                temperature: float = 0.5, seed: int = SEED) -> DataFrame:
    """All copies, globally shuffled: the columns of ``docs`` plus ``copy`` (from 1),
    ``rate`` (mean of the source) and ``shuffle_key``.  Columns of ``docs`` of those three
    names are replaced.

    The order of the result is the order of its partitions, each sorted by the hashed key.
    Null sources are one source.  Rows without an id, and rows of one id, draw apart from each
    other, equal rows included.  An empty table gives an empty result.
    """
    keep = [c for c in docs.columns if c not in ("copy", "rate", "shuffle_key")]
    rows = docs.select(
        F.struct(*[docs[c] for c in keep]).alias("row"), docs[source_col].alias("source"),
        docs[id_col].cast("string").alias("id"))
    rows = _own_draws(rows)
    rates = source_rates(docs, source_col, targets, total, temperature)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(PART_RATE)).cast("int"))
    rates = rates.select(F.col("source").alias("r_source"), "rate", parts.alias("parts"),
                         poisson_cdf(F.col("rate") / parts).alias("cdf"))
    same = rows.source.eqNullSafe(rates.r_source)
    if rates.count() <= BROADCAST_SOURCES:
        joined = rows.join(F.broadcast(rates), same)
    else:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
        rates = rates.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.join(rates, same & (rows.salt == rates.r_salt))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("parts")), F.lit(0),
        lambda acc, part: acc + F.size(F.filter(
            F.col("cdf"), lambda c: c < uniform(F.lit(str(seed)), F.col("id"), part.cast("string")))))
    # With one part, the usual case, the uniform number is hashed once for the row.
    one = F.size(F.filter(F.col("cdf"), lambda c: c < F.col("u")))
    joined = joined.withColumn("u", uniform(F.lit(str(seed)), F.col("id"), F.lit("1")))
    counted = joined.withColumn("n", F.when(F.col("parts") == 1, one).otherwise(drawn))
    copies = (counted.where("n > 0")
              .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
              .withColumn("shuffle_key", hashed52(F.lit(f"{seed}-order"), F.col("id"),
                                                  F.col("copy").cast("string"))))
    return (copies.select("row.*", "copy", "rate", "shuffle_key")
            .repartition("shuffle_key").sortWithinPartitions("shuffle_key"))


def op8_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` mixed towards shares of sqrt(rows of the source), total unchanged."""
    mixed = poisson_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.withColumn("rate", F.round("rate", 9))


SQL = f"""
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, sqrt(n) * (SELECT sum(n) FROM sizes) / (SELECT sum(sqrt(n)) FROM sizes) / n AS rate
          FROM sizes),
cdf(source, rate, k, p, c) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM cdf
  WHERE k < ceil(rate + 12 * sqrt(rate) + 24)),
drawn AS (
  SELECT d.doc_id, any_value(f.rate) AS rate, count(*) FILTER (WHERE f.c <
    (('0x' || substr(md5('{SEED}:' || d.doc_id || ':1'), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) AS n
  FROM documents d JOIN cdf f ON d.source IS NOT DISTINCT FROM f.source GROUP BY d.doc_id),
copies AS (SELECT doc_id, rate, unnest(range(1, n + 1)) AS copy FROM drawn WHERE n > 0)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy::INT AS copy, round(c.rate, 9) AS rate,
       ('0x' || substr(md5('{SEED}-order:' || d.doc_id || ':' || c.copy), 1, 13))::BIGINT AS shuffle_key
FROM copies c JOIN documents d USING (doc_id)
"""
