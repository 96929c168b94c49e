"""A training corpus from ``documents``: five stages, each over all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet to the shared folder and rereads it as the next stage's input, so a lost executor
never costs more than the stage it worked on.

1. toxicity: the network is fitted on the labelled documents among the input; documents
   scoring 0.7 or more go.
2. jaccard: of each group of near copies one row, that of the smallest id, stays.
3. decontaminate: documents with an occurrence of a benchmark window go.
4. mix: sources are brought towards shares of sqrt(size) by Poisson replication.
5. tokens: token ids in ORC; the result is read back from the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.llm.common import ID_BROADCAST_BYTES, staged
from tonality.llm.jaccard_join import near_copies
from tonality.llm.poisson_mix import poisson_mix
from tonality.llm.token_orc import default_tokenizer, read_token_orc, stream_digest, write_token_orc
from tonality.llm.toxicity import THRESHOLD, score_documents, train_toxicity
from tonality.llm.wu_manber import find_benchmark
from tonality.session import fresh_path


#: Texts and words an encoder holds at a time: the executors' heaps are in use by the last
#: stage, so its workers are kept small (252 MB instead of 390 MB).
TOKEN_BATCH_ROWS, TOKEN_MEMO_PIECES = 256, 200_000


def _picked(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """``docs`` joined (semi or anti) with (doc_id, text_key); broadcast by measured size."""
    rows = staged(rows.distinct(), "picked").select(
        F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key"))
    if rows.count() * 64 <= ID_BROADCAST_BYTES:
        rows = F.broadcast(rows)
    key = F.xxhash64(docs["text"].cast("string").cast("binary"))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("r_id")) & (key == F.col("r_key"))
    return docs.join(rows, same, how)


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` but the rows of the given (doc_id, text_key)."""
    return _picked(docs, rejected, "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects toxic documents.  Null and empty texts stay; without labels nothing goes."""
    model = train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_documents(docs, model, "toxicity_score")
    return scored.where(F.col("toxicity_score") < THRESHOLD).drop("toxicity_score")


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps exactly one row of each group: that of the smallest (doc_id, text key).

    Texts without words are no copies of each other and stay.  Rows of equal id and
    different text are rows of their own.  A row without an id stays only where no row of
    its group has one, and then once."""
    found = staged(near_copies(docs), "near-copies")
    kept = _without(docs, found.where("NOT keeps"))
    again = staged(found.where("keeps").groupBy("doc_id", "text_key").count().where("count > 1"), "equal-rows")
    if again.limit(1).count():
        # Rows that are one node (equal id and text): one of them stays.
        once = _picked(kept, again.select("doc_id", "text_key"), "left_semi").dropDuplicates(["doc_id", "text"])
        kept = _without(kept, again.select("doc_id", "text_key")).unionByName(once)
    return kept


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark window."""
    found = find_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.where(F.size("items") > 0).select("doc_id", "text_key"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows as before on average, sources by the square root of their size."""
    mixed = poisson_mix(docs)
    return mixed.select(*[c for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: its place in the token stream, length and checksum, read from the files."""
    path = write_token_orc(docs, fresh_path(spark, "corpus-tokens"), default_tokenizer(),
                           batch_rows=TOKEN_BATCH_ROWS, memo_pieces=TOKEN_MEMO_PIECES)
    return stream_digest(read_token_orc(spark, path), forget=True)


STAGES = [("toxicity", toxicity), ("jaccard", jaccard), ("decontaminate", decontaminate), ("mix", mix),
          ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs


#: Training a network, tokenizers and hashed sets are beyond SQL: tested by brute force.
ORACLE_SQL = None
