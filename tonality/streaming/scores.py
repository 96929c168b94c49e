"""Scoring a stream of texts.

The reference's text box is a loop: take a text, score it, show the result.  Here
texts arrive as files (``readStream``), each micro-batch runs the same batch
scoring plan through ``foreachBatch`` (the per-text row-number limit is not
allowed directly on a streaming frame), and the results land in a parquet sink.

Each micro-batch is written to a folder of its own and published as ``batch=<epoch id>`` by
one rename.  A batch re-run after a failure finds its epoch published and changes nothing,
or replaces what was never published: the sink is exactly-once given the checkpointed
source offsets, and ``read_sink`` (or any reader) sees whole epochs only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.scoring import TextModel, score_texts
from ..plans import staging
from ..session import fresh_path
from ..sources.vectors import VectorTable

RESULT_SCHEMA = ("{id} {kind}, {text} string, n_known bigint, score_pos double, score_neg double, "
                 "sentiment string, status string, output string")
RESULT_COLUMNS = ("doc_id", "text", "n_known", "score_pos", "score_neg", "sentiment",
                  "status", "output")


def text_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """Files arriving in the folder ``path`` (optionally only names matching ``glob``)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def score_stream(stream: DataFrame, vt: VectorTable, model: TextModel, sink: str,
                 checkpoint: str, id_col: str = "doc_id", text_col: str = "text",
                 processing_time: str | None = None):
    """Start the scoring query; returns the StreamingQuery.

    Default trigger: everything available now, then stop.  ``processing_time``
    (e.g. ``"5 seconds"``) keeps the query running like the reference's text box,
    scoring whatever arrived since the last micro-batch."""
    spark = stream.sparkSession

    def each(batch: DataFrame, epoch_id: int) -> None:
        target = f"{sink}/batch={epoch_id}"
        if staging.is_complete(spark, target):
            return
        scored = score_texts(batch.select(id_col, text_col), vt, model, spark, id_col, text_col,
                             unique_ids=False)
        private = f"{sink}/_writing/{uuid.uuid4().hex[:12]}"  # readers pass over such names
        scored.select(id_col, text_col, *RESULT_COLUMNS[2:]).write.parquet(private)
        staging.publish(spark, private, target)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = (writer.trigger(processingTime=processing_time) if processing_time
              else writer.trigger(availableNow=True))
    return writer.start()


def read_sink(spark: SparkSession, sink: str, id_type: str = "bigint", id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The published epochs of a sink: result columns and ``batch``; no rows before the first."""
    schema = RESULT_SCHEMA.format(id=id_col, kind=id_type, text=text_col)
    if not staging.path_exists(spark, sink):
        return spark.createDataFrame([], schema + ", batch int")
    fs, root = staging._fs(spark, sink)
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    done = [f"{sink}/{n}" for n in sorted(names) if n.startswith("batch=") and staging.is_complete(spark, f"{sink}/{n}")]
    if not done:
        return spark.createDataFrame([], schema + ", batch int")
    return spark.read.schema(schema + ", batch int").option("basePath", sink).parquet(*done)


def run_to_completion(spark: SparkSession, source: str, schema: T.StructType, vt: VectorTable,
                      model: TextModel, max_files_per_trigger: int | None = None,
                      glob: str | None = None) -> DataFrame:
    """Process everything available at ``source`` and return the sink read back; an empty
    source gives an empty frame of the same columns."""
    sink = fresh_path(spark, "stream-sink")
    ckpt = fresh_path(spark, "stream-checkpoint")
    q = score_stream(text_stream(spark, source, schema, max_files_per_trigger, glob), vt, model, sink, ckpt)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_sink(spark, sink, schema["doc_id"].dataType.simpleString())
