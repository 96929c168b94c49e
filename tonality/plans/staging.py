"""Do-once tables (S9) and the required-inputs gate.

A staged table counts as present only when its ``_SUCCESS`` marker exists: a folder
left half-written by a failed job is rewritten, not trusted.  Staged tables live
in the shared scratch folder, so they survive the loss of any executor and cut the
lineage of whatever produced them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_root


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jpath.getFileSystem(conf), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a finished Spark write (``_SUCCESS`` present)."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def drop(spark: SparkSession, path: str) -> None:
    """Remove a folder of ours that nothing reads any more, where there is one."""
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def publish(spark: SparkSession, private: str, target: str) -> bool:
    """Move the finished folder ``private`` to ``target``; False where another writer's
    finished copy is there already (then ours is discarded and theirs stays).

    The rename never replaces or enters an existing folder.  A half-written ``target``
    (no ``_SUCCESS``) is removed first; two writers that both do so still publish once."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    hadoop = jvm.org.apache.hadoop.fs
    fs, src = _fs(spark, private)
    _, dst = _fs(spark, target)
    for _ in range(3):
        if is_complete(spark, target):
            fs.delete(src, True)
            return False
        if fs.exists(dst):
            fs.delete(dst, True)
        fs.mkdirs(dst.getParent())
        context = hadoop.FileContext.getFileContext(fs.makeQualified(dst).toUri(), sc._jsc.hadoopConfiguration())
        none = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(src), fs.makeQualified(dst), none)
            return True
        except Py4JJavaError:
            if not fs.exists(src):  # the source is ours alone: moved, whatever was reported
                return is_complete(spark, target)
    raise OSError(f"could not publish {private} as {target}")


def materialize_once(spark: SparkSession, df_factory: Callable[[], DataFrame], path: str,
                     fmt: str = "parquet", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write the table at ``path`` unless a complete copy is there; return it read back.

    * absent               -> write
    * present, no _SUCCESS -> replace (a half-written copy is never trusted)
    * complete             -> skip the write entirely (``df_factory`` is not evaluated)

    A writer works in a folder of its own and publishes it by one rename, so readers see
    whole copies only; of several writers the first to finish wins and the others adopt
    its copy.
    """
    write_once(spark, df_factory, path, fmt, partition_by)
    return spark.read.format(fmt).load(path)


def write_once(spark: SparkSession, df_factory: Callable[[], DataFrame], path: str,
               fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """The writing half of ``materialize_once``."""
    path = path.rstrip("/")
    if not is_complete(spark, path):
        private = f"{path}.writing-{uuid.uuid4().hex[:12]}"
        writer = df_factory().write.format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(private)
        publish(spark, private, path)


def staged_path(spark: SparkSession, name: str, key: str) -> str:
    return f"{scratch_root(spark)}/staged/{name}-{key}"


def input_status(spark: SparkSession, inputs: dict[str, str]) -> DataFrame:
    """One row per required input: name, path, present (complete write or readable files)."""
    rows = []
    for name, path in inputs.items():
        present = is_complete(spark, path) or (
            path_exists(spark, path) and not _is_directory(spark, path))
        rows.append((name, path, present))
    return spark.createDataFrame(rows, "input string, path string, present boolean")


def require_inputs(spark: SparkSession, inputs: dict[str, str]) -> DataFrame:
    """Raise naming the missing inputs; otherwise return the status rows."""
    status = input_status(spark, inputs)
    missing = [r.input for r in status.collect() if not r.present]
    if missing:
        raise FileNotFoundError(
            "required inputs are missing or incomplete: " + ", ".join(
                f"{m} ({inputs[m]})" for m in missing))
    return status


def _is_directory(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory())
