"""Training-set assembly: class union, interleaving, minibatches (U1, W1-W3, W5,
F4, F5, F7, L2-L4, A1, A3, N3, P7).

The reference walks two file lists with one cursor: even cursor positions take the
next positive document, odd ones the next negative.  Here the position is a column
computed in closed form from each document's rank inside its (split, class):

    rn < m  ->  2 * rn + label          (alternating part, m = smaller class size)
    rn >= m ->  2 * m + (rn - m)        (the rest of the larger class)

The rank uses ``ordinal_within`` (distributed sort), not a window partitioned by
the two-valued class column, so no class is funnelled through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import LABEL_NAMES
from ..plans.broadcast import tiny
from ..plans.ranking import ordinal_within
from .tokens import MAX_LENGTH

# Fixed value: documents per minibatch.
BATCH_SIZE = 64


def split_counts(rv: DataFrame) -> DataFrame:
    """(split, sentiment, n_docs) -- A1 with F1/F2 as its grouping."""
    return rv.groupBy("split", "sentiment").agg(F.count(F.lit(1)).alias("n_docs"))


def class_union(rv: DataFrame, split: str | None = None) -> DataFrame:
    """Bag union of the positive and negative documents of a split."""
    sel = rv if split is None else rv.where(F.col("split") == split)
    pos = sel.where(F.col("label") == 0)
    neg = sel.where(F.col("label") == 1)
    return pos.unionByName(neg)


def class_sizes(rv: DataFrame) -> DataFrame:
    """(split, n_pos, n_neg, m, total): one row per split."""
    return (rv.groupBy("split")
            .agg(F.count(F.when(F.col("label") == 0, 1)).alias("n_pos"),
                 F.count(F.when(F.col("label") == 1, 1)).alias("n_neg"))
            .withColumn("m", F.least("n_pos", "n_neg"))
            .withColumn("total", F.col("n_pos") + F.col("n_neg")))


def interleave(rv: DataFrame) -> DataFrame:
    """Adds ``rn`` (rank in split x class by doc_id, from 0) and ``position``."""
    ranked = ordinal_within(rv, ["split", "label"], ["doc_id"], out="rn")
    # One row per split: bounded by construction.
    sizes = tiny(class_sizes(rv).select("split", "m"))
    pos = F.when(F.col("rn") < F.col("m"), 2 * F.col("rn") + F.col("label")).otherwise(
        2 * F.col("m") + (F.col("rn") - F.col("m")))
    return ranked.join(sizes, "split").withColumn("position", pos.cast("bigint")).drop("m")


def minibatches(iv: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Adds batch_id = position div batch_size and row_in_batch."""
    return (iv.withColumn("batch_id", F.floor(F.col("position") / batch_size).cast("bigint"))
            .withColumn("row_in_batch", F.pmod(F.col("position"), F.lit(batch_size)).cast("bigint")))


def parity_is_positive(position) -> F.Column:
    """The reference's label rule: even cursor positions are positive."""
    return F.pmod(position, F.lit(2)) == 0


def batch_lengths(mb: DataFrame, counts: DataFrame, max_len: int | None = MAX_LENGTH) -> DataFrame:
    """(split, batch_id, n_docs, max_known, max_len) per minibatch.

    ``counts`` carries (doc_id, n_known).  max_len = least(max n_known, 256).
    """
    j = mb.join(counts, "doc_id", "left").withColumn("n_known", F.coalesce("n_known", F.lit(0)))
    cap = F.max("n_known") if max_len is None else F.least(F.max("n_known"), F.lit(max_len))
    return j.groupBy("split", "batch_id").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.max("n_known").cast("bigint").alias("max_known"),
        cap.cast("bigint").alias("max_len"))


def attach_batch_length(mb_counts: DataFrame, max_len: int | None = MAX_LENGTH) -> DataFrame:
    """Each member gets its batch's padding target L and its own length n.

    The window is partitioned by (split, batch_id): at most ``BATCH_SIZE`` rows each.
    """
    w = Window.partitionBy("split", "batch_id")
    n = F.col("n_known") if max_len is None else F.least("n_known", F.lit(max_len))
    bmax = F.max("n_known").over(w)
    cap = bmax if max_len is None else F.least(bmax, F.lit(max_len))
    return mb_counts.withColumn("n", n.cast("bigint")).withColumn("L", cap.cast("bigint"))


def label_steps(trunc: DataFrame) -> DataFrame:
    """(doc_id, t, word, is_label_step): the label exists only at the last real step.

    Partitioned by document; the truncation bounds each partition to 256 rows.
    """
    w = Window.partitionBy("doc_id")
    return trunc.withColumn("is_label_step", F.col("t") == F.max("t").over(w))


def label_onehot(label) -> F.Column:
    """[1, 0] for positive (class 0), [0, 1] for negative (class 1)."""
    return F.when(label == 0, F.array(F.lit(1.0), F.lit(0.0))).otherwise(
        F.array(F.lit(0.0), F.lit(1.0)))


def label_names(spark: SparkSession, rv: DataFrame) -> DataFrame:
    """(label, label_name, n_docs): class index, its name and its document count."""
    names = spark.createDataFrame([(i, n) for i, n in enumerate(LABEL_NAMES)],
                                  "label int, label_name string")
    counts = rv.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs"))
    # Two literal rows: bounded by construction.
    return (tiny(names).join(counts, "label", "left")
            .select(F.col("label").cast("bigint").alias("label"), "label_name",
                    F.coalesce("n_docs", F.lit(0)).cast("bigint").alias("n_docs")))


def batch_fetch(mb: DataFrame, rv: DataFrame) -> DataFrame:
    """Per (split, batch_id): rows, first and last position, has_next."""
    sizes = tiny(class_sizes(rv).select("split", "total"))
    per = mb.groupBy("split", "batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("position").alias("first_position"),
        F.max("position").alias("last_position"))
    return (per.join(sizes, "split")
            .withColumn("has_next", F.col("last_position") + 1 < F.col("total"))
            .drop("total"))


def fetch_batch(mb: DataFrame, split: str, batch_id: int) -> DataFrame:
    """The rows of one minibatch in order; empty past the end."""
    return (mb.where((F.col("split") == split) & (F.col("batch_id") == batch_id))
            .orderBy("row_in_batch"))


def epoch_schedule(mb: DataFrame, n_epochs: int = 1) -> DataFrame:
    """(epoch, step, split, batch_id, n_docs): every batch once per epoch, in order (L4).

    A generator on the per-batch rows -- not a cross join -- repeats the batches.
    """
    per = mb.groupBy("split", "batch_id").agg(F.count(F.lit(1)).alias("n_docs"))
    nb = per.groupBy("split").agg(F.count(F.lit(1)).alias("n_batches"))
    # One row per split: bounded by construction.
    return (per.join(tiny(nb), "split")
            .select(F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(n_epochs).cast("bigint")))
                    .alias("epoch"), "split", "batch_id", "n_docs", "n_batches")
            .withColumn("step", (F.col("epoch") - 1) * F.col("n_batches") + F.col("batch_id"))
            .drop("n_batches"))
