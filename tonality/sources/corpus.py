"""Corpus files: one text per file.

Layout read: ``{root}/{train|test}/{pos|neg}/<file>`` (also accepted with
Hive-style folder names ``split=train/sentiment=pos/...``, which is what the
round-trip writer produces).  ``wholetext`` makes each file one row; split and class
are the last two folders above the file (whatever the root's own path holds).  File names
repeat from folder to folder, so a document's id is a hash of its path unless a
``doc_id=<n>`` folder or a file ``doc_id=<n>.txt`` names it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import LABEL_NAMES
from .text_files import reachable, read_files, task_folders, write_files

# Fixed path patterns.
TREE_RX = r"/(?:split=)?(train|test)/(?:sentiment=)?(pos|neg)/(?:doc_id=-?\d+/)?[^/]*$"
ID_RX = r"/doc_id=(-?\d+)(?:/[^/]*|\.txt)$"


def strip_final_newline(value: Column) -> Column:
    """The text writer ends every record with one line feed: remove exactly that one."""
    return F.when(value.endswith("\n"), F.expr("left(value, length(value) - 1)")).otherwise(value)


def _doc_id_from_path(path: Column) -> Column:
    named = F.regexp_extract(path, ID_RX, 1)
    return F.when(named != "", named.cast("bigint")).otherwise(F.xxhash64(path))


def read_text_files(spark: SparkSession, root: str, strip_newline: bool = True) -> DataFrame:
    """(path, text): every file under ``root`` as one row."""
    folders = task_folders(root)
    # Spark's own reader lists every file on the driver: for trees that others wrote.
    raw = read_files(spark, root, folders) if folders else (
        spark.read.text(root, wholetext=True, recursiveFileLookup=True)
        .select(F.col("_metadata.file_path").alias("path"), "value"))
    text = strip_final_newline(F.col("value")) if strip_newline else F.col("value")
    return raw.select("path", text.alias("text"))


def scan_corpus(spark: SparkSession, root: str, strip_newline: bool = True) -> DataFrame:
    """(doc_id, text, split, sentiment) from a labelled corpus tree."""
    files = read_text_files(spark, root, strip_newline)
    cls = F.regexp_extract("path", TREE_RX, 2)
    return (files.where(cls != "")
            .select(_doc_id_from_path(F.col("path")).alias("doc_id"), "text",
                    F.regexp_extract("path", TREE_RX, 1).alias("split"),
                    F.when(cls == "pos", F.lit(LABEL_NAMES[0])).otherwise(F.lit(LABEL_NAMES[1]))
                    .alias("sentiment")))


def _file_name() -> Column:
    return F.concat(F.lit("doc_id="), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(".txt"))


def write_corpus(rv: DataFrame, root: str) -> None:
    """Write (doc_id, text, split, sentiment) one document per file:
    ``split=<s>/sentiment=<pos|neg>/doc_id=<id>.txt`` below a folder a task (where tasks cannot
    reach the store, ``.../doc_id=<id>/part-*.txt`` by Spark's writer)."""
    cls = F.when(F.col("sentiment") == LABEL_NAMES[0], F.lit("pos")).otherwise(F.lit("neg"))
    if reachable(root):
        folder = F.concat(F.lit("split="), F.col("split"), F.lit("/sentiment="), cls)
        return write_files(rv, folder, _file_name(), "text", root)
    (rv.select(F.col("split"), cls.alias("sentiment"), "doc_id", F.col("text").alias("value"))
     .repartition("split", "sentiment", "doc_id")
     .write.mode("overwrite").partitionBy("split", "sentiment", "doc_id").text(root))


def write_text_files(docs: DataFrame, root: str) -> None:
    """One file per (doc_id, text) row: ``doc_id=<id>.txt`` below a folder a task (or
    ``doc_id=<id>/part-*.txt``, as ``write_corpus``)."""
    if reachable(root):
        return write_files(docs, F.lit(""), _file_name(), "text", root)
    (docs.select("doc_id", F.col("text").alias("value")).repartition("doc_id")
     .write.mode("overwrite").partitionBy("doc_id").text(root))


def scan_text_files(spark: SparkSession, root: str) -> DataFrame:
    files = read_text_files(spark, root)
    return files.select(_doc_id_from_path(F.col("path")).alias("doc_id"), "text")
