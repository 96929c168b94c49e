"""Shared pieces: word rules over bytes, Arrow batch bounds, staged tables, id lookups."""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Rows and bytes of one Arrow batch: bounds what a Python worker holds of the texts.
BATCH_ROWS = 1024
BATCH_BYTES = 16 << 20

#: An id set is broadcast below this many bytes (measured by a count), shuffled above it.
ID_BROADCAST_BYTES = 64 << 20

# Letters and digits stay (A-Z as a-z), bytes from 0x80 stay, everything else parts words.
_ALNUM = bytes(
    (b + 32) if 0x41 <= b <= 0x5A
    else b if (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
    else 0x20
    for b in range(256))


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text, A-Z lower-cased."""
    return text.translate(_ALNUM).split() if text else []


def space_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z lower-cased.

    ``bytes.lower`` touches ASCII letters only and ``bytes.split`` parts at exactly
    the six ASCII white-space bytes.
    """
    return text.lower().split() if text else []


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def crc_of_id(doc_id: Column) -> Column:
    """Unsigned crc32 of the id as text."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def py_crc_of_id(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers and bound the Arrow batches of this session."""
    ship_package(spark)
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with the text as bytes: other columns, whatever their names, stay out."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       docs[text_col].cast("string").cast("binary").alias("text"))


def staged_at(df: DataFrame, name: str, partition_by: str | None = None, codec: str | None = None) -> tuple[DataFrame, str]:
    """``staged`` and the path of its table, for ``staging.drop`` once nothing reads it any more."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write.option("compression", codec) if codec else df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write to a fresh table in the shared folder and read it back: cuts the lineage
    with files that survive the loss of any executor."""
    return staged_at(df, name, partition_by)[0]


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs: it does so when the driver's JVM
    has collected what refers to them, which a large heap puts off while the disk fills."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def batches(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(ids, texts as bytes) of each Arrow batch of ``texts()``."""
    for b in it:
        yield b.column(0).to_pylist(), b.column(1).to_pylist()


def trim_memory() -> None:
    """Return what this worker's allocators hold free to the machine: workers live on from
    stage to stage, idle ones too, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def only_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose key is in ``ids`` (distinct): the id set is broadcast when
    its measured size allows, else both sides are shuffled on the key."""
    if ids.count() * 64 <= ID_BROADCAST_BYTES:
        return docs.join(F.broadcast(ids), key, "left_semi")
    return docs.join(ids.hint("merge"), key, "left_semi")
