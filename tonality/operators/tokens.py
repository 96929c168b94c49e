"""Vocabulary joins over token streams.

Token frames are long: (doc_id, pos, word).  The vocabulary side is the staged
``VectorTable``; ``VectorTable.join`` broadcasts it when its measured size allows,
otherwise it broadcasts only the most frequent words and shuffles the remaining
tokens against the rest, so hot words stay out of the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.vectors import VectorTable

# Fixed value: truncation length of a sequence (number of known words kept).
MAX_LENGTH = 256


def known_tokens(toks: DataFrame, vt: VectorTable, spark: SparkSession,
                 id_col: str = "doc_id") -> DataFrame:
    """(id, pos, word, t): tokens that have a vector, renumbered 1.. within each text.

    Left-semi join on ``word`` (J1), then ``row_number`` by ``pos`` per text (W4).
    """
    known = vt.join(toks, spark, "left_semi", with_vectors=False)
    w = Window.partitionBy(id_col).orderBy("pos")
    return known.select(id_col, "pos", "word", F.row_number().over(w).cast("bigint").alias("t"))


def truncated_tokens(toks: DataFrame, vt: VectorTable, spark: SparkSession,
                     max_len: int | None = MAX_LENGTH, id_col: str = "doc_id") -> DataFrame:
    """Known tokens with ``t <= max_len`` (L1).  ``max_len=None`` keeps everything.

    ``row_number() <= k`` is planned as a WindowGroupLimit, applied before the
    shuffle as well as after it, so a 20,000-word text ships at most ``k`` rows.
    """
    known = known_tokens(toks, vt, spark, id_col)
    return known if max_len is None else known.where(F.col("t") <= max_len)


def first_tokens(toks: DataFrame, max_len: int | None = MAX_LENGTH, id_col: str = "doc_id") -> DataFrame:
    """(id, pos, word, t): tokens, known or not, numbered 1.. within each text up to ``max_len``."""
    order = Window.partitionBy(id_col).orderBy("pos")
    steps = toks.withColumn("t", F.row_number().over(order).cast("bigint"))
    return (steps if max_len is None else steps.where(F.col("t") <= max_len)).select(id_col, "pos", "word", "t")


def known_counts(docs: DataFrame, toks: DataFrame, vt: VectorTable, spark: SparkSession,
                 id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, n_known) for every text, zero when none (A2).

    Both counts come from one aggregate over the tokens tagged known/unknown by a
    left-outer lookup carrying a flag, so the tokens are scanned once.
    """
    tagged = vt.join(toks, spark, "left", with_vectors=False, flag="_known")
    per_doc = tagged.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.count("_known").alias("n_known"))
    return (docs.select(id_col).join(per_doc, id_col, "left")
            .select(id_col,
                    F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"),
                    F.coalesce("n_known", F.lit(0)).cast("bigint").alias("n_known")))


def oov_words(toks: DataFrame, vt: VectorTable, spark: SparkSession) -> DataFrame:
    """(word, n): words without a vector and how often they occur (J4, left anti).

    Words are counted first, so the join sees a row a distinct word, not a row a token.
    """
    counts = toks.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return vt.join(counts, spark, "left_anti", with_vectors=False).select("word", "n")


def token_vector_lookup(toks: DataFrame, vt: VectorTable, spark: SparkSession) -> DataFrame:
    """Every token with its vector or null (J3, left outer)."""
    return vt.join(toks, spark, "left")


def sequence_arrays(trunc: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n, words): the truncated known words of each text as an ordered array.

    At most ``MAX_LENGTH`` elements per text, so the per-group collect is bounded.
    """
    return (trunc.groupBy(id_col)
            .agg(F.sort_array(F.collect_list(F.struct("t", "word"))).alias("_s"))
            .select(id_col, F.size("_s").cast("bigint").alias("n"),
                    F.transform("_s", lambda s: s["word"]).alias("words")))
