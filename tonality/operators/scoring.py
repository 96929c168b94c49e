"""Scoring: the closed-form centroid model (M9), softmax pair (N1), verdicts (N2, T3),
invalid-input status (F6) and the shared text -> score path (M4, M5).

The centroid model is fitted by one distributed aggregate (class means of the
pooled vectors); its parameters -- one weight per dimension and a bias -- are
bounded by the vector dimension and are embedded in the scoring expression, so
scoring is a projection with no join and no shuffle.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import INVALID_INPUT, echo_output, verdict, verdict_text
from ..sources import fixtures
from ..sources.vectors import VectorTable
from .lookup import pooled_words, text_words
from .tokens import MAX_LENGTH, truncated_tokens
from .vectors import WIDE_DIM, pooled_vectors, whole_mean

STATUS_OK = "OK"
# Bumped whenever training changes, so stored models from older code are not reused.
MODEL_VERSION = 1


def dot(weights: list[float], vec: Column) -> Column:
    w = F.array(*[F.lit(float(x)) for x in weights])
    return F.aggregate(F.zip_with(w, vec, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)


def softmax_pair(z: Column) -> tuple[Column, Column]:
    """Two-output softmax with outputs (z, 0): (p_pos, p_neg)."""
    return 1.0 / (1.0 + F.exp(-z)), 1.0 / (1.0 + F.exp(z))


class TextModel(Protocol):
    """What text, message and stream scoring need of a model, whatever its kind."""

    def score_tokens(self, trunc: DataFrame, vt: VectorTable, spark: SparkSession, id_col: str) -> DataFrame:
        """Truncated known tokens (id, t, word) -> (id, n_known, score_pos, score_neg, sentiment),
        one row for each text with a known word."""


@dataclass
class CentroidModel:
    """Linear scorer: w = mean(positive) - mean(negative), bias at the midpoint."""

    weights: list[float]
    bias: float
    params: dict = field(default_factory=dict)

    def logit(self, pooled: Column) -> Column:
        return dot(self.weights, pooled) + F.lit(float(self.bias))

    def transform(self, df: DataFrame, pooled_col: str = "pooled", digits: int = 6) -> DataFrame:
        """Adds z, the verdict (from the unrounded pair), and score_pos, score_neg as
        printed values rounded to ``digits``."""
        z = self.logit(F.col(pooled_col))
        p, q = softmax_pair(F.col("z"))
        return (df.withColumn("z", z)
                .withColumn("verdict", verdict(p, q))
                .withColumn("score_pos", F.round(p, digits))
                .withColumn("score_neg", F.round(q, digits)))

    def score_tokens(self, trunc: DataFrame, vt: VectorTable, spark: SparkSession, id_col: str) -> DataFrame:
        """(id, n_known, score_pos, score_neg, sentiment) of every text with a known word."""
        pooled = pooled_vectors(trunc, vt, spark, id_col)
        return self.transform(pooled).select(id_col, F.col("n").alias("n_known"), "score_pos", "score_neg",
                                             F.col("verdict").alias("sentiment"))

    # -- persistence (S11/S12): one-row parquet of named parameters
    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(
            [(list(map(float, self.weights)), float(self.bias), json.dumps(self.params, sort_keys=True))],
            "weights array<double>, bias double, config string",
        ).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "CentroidModel":
        row = spark.read.parquet(path).first()
        return cls(list(row["weights"]), float(row["bias"]), json.loads(row["config"]))


def fit_centroid(pooled: DataFrame, dim: int, label_col: str = "label") -> CentroidModel:
    """Fit from (pooled, label) rows; label 0 = positive, 1 = negative.

    One aggregate with a partial phase; the result is two rows (one per class).
    """
    means = (pooled.where(F.col("pooled").isNotNull())
             .groupBy(label_col).agg(whole_mean("pooled").alias("m"))
             .collect())
    by_label = {int(r[label_col]): [float(x) for x in r["m"]] for r in means}
    if 0 not in by_label or 1 not in by_label:
        raise ValueError("both classes need at least one document with a known word")
    mp, mn = by_label[0], by_label[1]
    w = [a - b for a, b in zip(mp, mn)]
    b = -sum(wi * (a + c) / 2.0 for wi, a, c in zip(w, mp, mn))
    return CentroidModel(w, b, {"kind": "centroid", "dim": dim})


def labelled_pooled(spark: SparkSession, sf_dir: str, vt: VectorTable,
                    max_len: int | None = MAX_LENGTH) -> DataFrame:
    """(doc_id, split, sentiment, label, n, pooled) for labelled documents; documents
    without a known word keep ``n = 0`` and a null ``pooled``."""
    return pooled_corpus(fixtures.reviews(spark, sf_dir), vt, spark, max_len)


def pooled_corpus(rv: DataFrame, vt: VectorTable, spark: SparkSession,
                  max_len: int | None = MAX_LENGTH) -> DataFrame:
    """Any labelled corpus (doc_id, text, split, sentiment, label) -> pooled rows."""
    if 0 < vt.dim <= WIDE_DIM:
        # The words are picked where a text is read: no task sorts tokens.
        pooled = pooled_words(text_words(rv.select("doc_id", "text"), vt, spark, max_len), vt, spark)
    else:
        toks = fixtures.tokens_of(rv.select("doc_id", "text"))
        pooled = pooled_vectors(truncated_tokens(toks, vt, spark, max_len), vt, spark)
    meta = rv.select("doc_id", "split", "sentiment", "label")
    return (meta.join(pooled, "doc_id", "left")
            .withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint")))


def train_centroid(spark: SparkSession, sf_dir: str, vt: VectorTable,
                   max_len: int | None = MAX_LENGTH, lp: DataFrame | None = None) -> CentroidModel:
    lp = labelled_pooled(spark, sf_dir, vt, max_len) if lp is None else lp
    return fit_centroid(lp.where((F.col("split") == "train") & (F.col("n") > 0)), vt.dim)


def stored_centroid(spark: SparkSession, sf_dir: str, vt: VectorTable) -> CentroidModel:
    """Train once, reuse after (M7): the model is kept next to the staged vocabulary
    and trained only when no complete stored copy exists."""
    from ..plans.staging import is_complete

    path = vt.path.rstrip("/") + f"-centroid-model-v{MODEL_VERSION}"
    if path not in _STORED:
        if not is_complete(spark, path):
            train_centroid(spark, sf_dir, vt).save(spark, path)
        _STORED[path] = CentroidModel.load(spark, path)
    return _STORED[path]


# Stored models are immutable once complete: loaded once per process.
_STORED: dict[str, CentroidModel] = {}


def score_texts(df: DataFrame, vt: VectorTable, model: TextModel, spark: SparkSession,
                id_col: str = "doc_id", text_col: str = "text",
                max_len: int | None = MAX_LENGTH, unique_ids: bool = True) -> DataFrame:
    """Score every row of ``df`` (M5) with a model of any kind (``models.load_model``).

    Output: the input columns plus n_known, score_pos, score_neg, sentiment, status,
    output.  A null text or a text with no known word gets the invalid-input status
    and null scores instead of an error (F6).

    ``unique_ids=False`` makes no use of ``id_col``: each distinct text is scored once and
    its rows, whatever their ids, get that score.
    """
    if not unique_ids:
        key = "_text_key"
        keyed = df.withColumn(key, F.md5(F.col(text_col).cast("binary")))
        once = keyed.where(F.col(key).isNotNull()).select(key, text_col).dropDuplicates([key])
        scored = score_texts(once, vt, model, spark, key, text_col, max_len)
        new = [c for c in scored.columns if c not in (key, text_col)]
        out = keyed.join(scored.select(key, *new), key, "left").drop(key)
        return (out.withColumn("status", F.coalesce("status", F.lit(INVALID_INPUT)))
                .withColumn("n_known", F.coalesce("n_known", F.lit(0)).cast("bigint"))
                .withColumn("output", F.coalesce("output", echo_output(F.col(text_col), F.lit(INVALID_INPUT)))))
    # Rows with a key go through one plan whose text side and token side share the
    # same filtered exchange (so it is computed once); rows without a key cannot be
    # joined and are appended as invalid input.
    keyed = df.where(F.col(id_col).isNotNull())
    texts = keyed.select(id_col, text_col)
    if hasattr(model, "score_docs"):
        scored = model.score_docs(texts, vt, spark, id_col, text_col, max_len)
    else:
        toks = fixtures.tokens_of(texts, id_col, text_col)
        scored = model.score_tokens(truncated_tokens(toks, vt, spark, max_len, id_col), vt, spark, id_col)
    unkeyed = df.where(F.col(id_col).isNull()).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in scored.schema.fields if f.name != id_col])
    out = keyed.join(scored, id_col, "left").unionByName(unkeyed)
    invalid = F.col(text_col).isNull() | F.col("n_known").isNull()
    return (out.withColumn("status", F.when(invalid, F.lit(INVALID_INPUT)).otherwise(F.lit(STATUS_OK)))
            .withColumn("n_known", F.coalesce("n_known", F.lit(0)).cast("bigint"))
            .withColumn("output", echo_output(F.col(text_col),
                                              verdict_text(F.col("score_pos"), F.col("score_neg"),
                                                           F.col("sentiment")))))
