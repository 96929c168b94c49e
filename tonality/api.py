"""User-facing entry points: the reference's three programs over real inputs.

* ``train_and_evaluate`` -- labelled corpus tree + word vectors -> model, metrics
* ``score_email_csv``    -- e-mail CSV with the declared schema -> one verdict per message
* ``score_text`` / ``score_folder_stream`` -- free texts, as a frame or as a file stream

Each scoring program takes a model of any kind (``load_model``).  Models are stored once and reused (train only when absent).  All results are
DataFrames; nothing is collected except model parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.text import LABEL_NAMES
from .operators import classifier as clf
from .operators import evaluate as ev
from .operators import messages as msg
from .operators import sequence_model as sm
from .operators import tensors as tz
from .operators.adam import AdamModel, fit_adam
from .operators.models import KINDS, load_model  # noqa: F401 - load_model is part of the interface
from .operators.scoring import CentroidModel, TextModel, fit_centroid, pooled_corpus, score_texts
from .plans import staging
from .session import fresh_path
from .sources import binary_vectors as bv
from .sources import corpus as cp
from .sources import email_csv as ec
from .sources import vectors as sv
from .streaming import scores as st

MODEL_KINDS = tuple(KINDS)


def load_vectors(spark: SparkSession, path: str, fmt: str = "auto", dim: int | None = None) -> sv.VectorTable:
    """Stage a word-vector table (parquet with word/vector, or a text or binary vector file,
    .gz allowed) in the shared folder and measure it."""
    if fmt == "auto":
        name = path.rstrip("/")
        fmt = ("parquet" if name.endswith(".parquet") else "binary" if name.endswith((".bin", ".bin.gz")) else "text")
    if fmt == "parquet":
        df = spark.read.parquet(path).select("word", F.col("vector").cast("array<float>"))
    elif fmt == "binary":
        df = bv.read_vector_binary(spark, path)
    else:
        df = sv.read_vector_text(spark, path, dim)
    return sv.stage_vectors(spark, df, fresh_path(spark, "vectors"))


def labelled_corpus(spark: SparkSession, root: str) -> DataFrame:
    """``{root}/{train|test}/{pos|neg}/<file>`` -> (doc_id, text, split, sentiment, label)."""
    rv = cp.scan_corpus(spark, root)
    return rv.withColumn("label", F.when(F.col("sentiment") == LABEL_NAMES[0], 0).otherwise(1))


@dataclass
class Trained:
    kind: str
    path: str
    metrics: DataFrame
    confusion: DataFrame


def train_and_evaluate(spark: SparkSession, corpus: DataFrame, vt: sv.VectorTable, model_path: str,
                       kind: str = "centroid", hidden: int = sm.REFERENCE_HIDDEN, epochs: int = 1) -> Trained:
    """Fit on the train split (unless a complete model is stored at ``model_path``),
    score the test split, return confusion matrix and per-class metrics."""
    if kind not in MODEL_KINDS:
        raise ValueError(f"kind must be one of {MODEL_KINDS}")
    if kind == "lstm":
        members = tz.word_members(corpus, vt, spark).checkpoint()
        if not staging.is_complete(spark, model_path):
            model, _ = sm.train(spark, members.where(F.col("split") == "train"), vt.dim,
                                hidden=hidden, epochs=epochs, vt=vt,
                                state_path=model_path.rstrip("/") + "-training")  # a killed fit goes on
            model.save(spark, model_path)
        model = sm.SequenceModel.load(spark, model_path)
        test = members.where(F.col("split") == "test")
        held = [c for c in ("words", "cold") if c in test.columns]
        scored = sm.score(test.select("doc_id", *held), model, vt=vt).join(
            test.select("doc_id", "sentiment"), "doc_id")
    else:
        lp = pooled_corpus(corpus, vt, spark).checkpoint()
        train = lp.where((F.col("split") == "train") & (F.col("n") > 0))
        test = lp.where(F.col("split") == "test")
        if kind == "centroid":
            if not staging.is_complete(spark, model_path):
                fit_centroid(train, vt.dim).save(spark, model_path)
            scored = CentroidModel.load(spark, model_path).transform(test)
        elif kind == "adam":
            if not staging.is_complete(spark, model_path):
                fit_adam(train, vt.dim, epochs=epochs)[0].save(spark, model_path)
            scored = AdamModel.load(spark, model_path).scorer().transform(test)
        else:
            model, _ = clf.fit_or_load(spark, model_path, train, dim=vt.dim)
            scored = clf.score_logistic(model, test)
    cm = ev.confusion_matrix(scored)
    return Trained(kind, model_path, ev.classification_metrics(cm), cm)


def bucket_documents(spark: SparkSession, docs: DataFrame, n_buckets: int, path: str | None = None) -> DataFrame:
    """(doc_id, text) rewritten once as a table bucketed by doc_id; scoring and pooling
    over it need no exchange.  ``path`` defaults to a new folder in the shared scratch."""
    from .sources.bucketed import bucketed_documents

    return bucketed_documents(spark, docs, path or fresh_path(spark, "documents-bucketed"), n_buckets)


def score_email_csv(spark: SparkSession, csv_path: str, vt: sv.VectorTable, model: TextModel,
                    header: bool = False) -> DataFrame:
    """The declared 27-column CSV -> (msg_key, raw_email, scores, sentiment, status, output)."""
    return msg.email_sentiment(ec.read_email_csv(spark, csv_path, header=header), vt, model, spark)


def score_text(spark: SparkSession, texts: list[str] | DataFrame, vt: sv.VectorTable,
               model: TextModel) -> DataFrame:
    """Free texts -> (doc_id, text, score_pos, score_neg, sentiment, status, output)."""
    if not isinstance(texts, DataFrame):
        texts = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return score_texts(texts, vt, model, spark).select(
        "doc_id", "text", "score_pos", "score_neg", "sentiment", "status", "output")


def score_folder_stream(spark: SparkSession, folder: str, vt: sv.VectorTable,
                        model: TextModel) -> DataFrame:
    """Parquet files of (doc_id, text) arriving in ``folder``; processes what is there."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    return st.run_to_completion(spark, folder, schema, vt, model)
