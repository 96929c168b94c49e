"""Per-document sequences and minibatch tensors.

``doc_sequences`` gathers each document's truncated words into one ordered array (at most
256 steps per document, so the per-group collect is bounded) and fetches their vectors
after the last shuffle (``lookup.py``).  Padding,
masks and label tensors are array expressions over that row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..sources import fixtures
from ..sources.vectors import VectorTable
from . import dataset as ds
from . import tokens as tok
from .lookup import doc_words, text_words, token_words, with_vectors


def doc_sequences(trunc: DataFrame, vt: VectorTable, spark: SparkSession,
                  id_col: str = "doc_id") -> DataFrame:
    """(id, n, seq): vectors of the truncated known words in step order."""
    return with_vectors(doc_words(trunc, vt, spark, id_col), vt, spark).select(
        id_col, F.size("seq").cast("bigint").alias("n"), "seq")


def text_sequences(docs: DataFrame, vt: VectorTable, spark: SparkSession,
                   max_len: int | None = tok.MAX_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_sequences`` of the texts themselves, whose words are picked where they are read."""
    words = text_words(docs, vt, spark, max_len, id_col, text_col).drop("n_tokens", "n_known")
    return with_vectors(words.where(F.size("words") > 0), vt, spark).select(
        id_col, F.size("seq").cast("bigint").alias("n"), "seq")


def batch_members(spark: SparkSession, sf_dir: str, vt: VectorTable,
                  max_len: int | None = tok.MAX_LENGTH) -> DataFrame:
    """Labelled documents with split, label, batch_id, row_in_batch, n (own length),
    L (batch padding target) and seq (possibly empty)."""
    return corpus_members(fixtures.reviews(spark, sf_dir), vt, spark, max_len)


def corpus_members(rv: DataFrame, vt: VectorTable, spark: SparkSession,
                   max_len: int | None = tok.MAX_LENGTH) -> DataFrame:
    """``batch_members`` for any labelled corpus (doc_id, text, split, sentiment, label)."""
    return with_vectors(word_members(rv, vt, spark, max_len), vt, spark)


def word_members(rv: DataFrame, vt: VectorTable, spark: SparkSession,
                 max_len: int | None = tok.MAX_LENGTH, joined: bool = False) -> DataFrame:
    """``corpus_members`` with each sequence as its words (null: none), for checkpoints,
    shuffles and training tables.  ``joined``: by joined tokens, in built-in expressions only."""
    mb = ds.minibatches(ds.interleave(rv.select("doc_id", "split", "sentiment", "label")))
    # n_known before truncation decides the batch target (capped at max_len).
    texts = rv.select("doc_id", "text")
    words = (token_words(fixtures.tokens_of(texts), vt, spark, max_len) if joined
             else text_words(texts, vt, spark, max_len)).drop("n_tokens")
    words = words.withColumn("words", F.when(F.size("words") > 0, F.col("words")))
    j = (mb.join(rv.select("doc_id").join(words, "doc_id", "left"), "doc_id", "left")
         .withColumn("n_known", F.coalesce("n_known", F.lit(0))))
    return ds.attach_batch_length(j, max_len)


def with_tensors(members: DataFrame, dim: int) -> DataFrame:
    """Adds features (padded), labels (one-hot at the last step), feature_mask, label_mask."""
    return (members
            .withColumn("features", A.pad_sequence("seq", "L", dim))
            .withColumn("labels", A.label_tensor("n", "L", ds.label_onehot(F.col("label"))))
            .withColumn("feature_mask", A.feature_mask("n", "L"))
            .withColumn("label_mask", A.label_mask("n", "L")))


def training_batches(members: DataFrame, dim: int) -> DataFrame:
    """One row per (split, batch_id): the four tensors as arrays ordered by row.

    A batch has at most 64 members of at most 256 steps, so each row is bounded.
    """
    t = with_tensors(members, dim)
    return (t.groupBy("split", "batch_id")
            .agg(F.sort_array(F.collect_list(F.struct(
                "row_in_batch", "doc_id", "features", "labels", "feature_mask", "label_mask")))
                .alias("rows"))
            .select("split", "batch_id", F.size("rows").cast("bigint").alias("n_docs"),
                    F.struct(
                        F.transform("rows", lambda r: r["features"]).alias("features"),
                        F.transform("rows", lambda r: r["labels"]).alias("labels"),
                        F.transform("rows", lambda r: r["feature_mask"]).alias("features_mask"),
                        F.transform("rows", lambda r: r["label_mask"]).alias("labels_mask"),
                    ).alias("dataset")))


def inference_shape(counts: DataFrame, max_len: int = tok.MAX_LENGTH) -> DataFrame:
    """Scoring-time tensor shape per text (X7): out_len = greatest(max_len, n_known),
    filled = least(max_len, n_known)."""
    return counts.select(
        "*",
        F.greatest(F.lit(max_len), F.col("n_known")).cast("bigint").alias("out_len"),
        F.least(F.lit(max_len), F.col("n_known")).cast("bigint").alias("filled"))


def inference_tensors(docs: DataFrame, toks: DataFrame | None, vt: VectorTable, spark: SparkSession,
                      max_len: int = tok.MAX_LENGTH, fill: str = "known", id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The scoring-time tensor of each text (X7), built text by text without a batch.

    (id, n_tokens, n_known, out_len, filled, tensor): ``out_len`` = greatest(max_len, n_known)
    steps of the vectors' dimension, zero beyond the filled ones.  ``fill='known'`` puts the
    first ``max_len`` known words there; ``fill='all'`` lets every token, known or not, take
    a step (unknown ones stay zero), as the reference's loop counts them (Q1).  ``toks``: the
    tokens of the texts, where they are not to be taken from ``docs`` themselves.
    """
    if fill not in ("known", "all"):
        raise ValueError("fill must be 'known' or 'all'")
    words = (text_words(docs, vt, spark, max_len, id_col, text_col, every=fill == "all") if toks is None
             else token_words(toks, vt, spark, max_len, id_col, every=fill == "all"))
    # Null ids meet no row: their texts have no step.
    words = docs.select(id_col).join(words, id_col, "left")
    for c in ("n_tokens", "n_known"):
        words = words.withColumn(c, F.coalesce(c, F.lit(0)).cast("bigint"))
    shape = inference_shape(words, max_len)
    if fill == "all":
        shape = shape.withColumn("filled", F.least(F.lit(max_len), F.col("n_tokens")).cast("bigint"))
    # Words are joined, vectors are fetched after the last shuffle (unknown words are zero).
    return (with_vectors(shape, vt, spark, zeros=True)
            # tokens of ``fill='all'`` may outnumber the steps of a text with few known words
            .withColumn("seq", F.slice("seq", 1, F.col("out_len").cast("int")))
            .withColumn("tensor", A.pad_sequence("seq", "out_len", vt.dim)).drop("seq"))
