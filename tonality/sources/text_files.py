"""One text per file, written by tasks as a Python data source (the writing half of S1, S2).

``df.write.format("text_files")``: rows (folder, name, content) become files of their own;
neighbouring rows of one name share a file, a line each.  A task fills a folder of its own in
a private place, and the job's commit moves one folder a task, so neither the driver nor the
commit handles single files; ``read_files`` gives each folder back to a task.  Spark's text writer with a partition folder a document makes two
folder levels, a checksum file and a rename for each.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..session import is_local_fs, local_path, ship_package
from .files import FolderCommit, resolve

# Files, and bytes of them, that a task reads before it hands them on.
READ_FILES, READ_BYTES = 1000, 8 << 20


@dataclass
class FilesWritten(WriterCommitMessage):
    names: list


class TextFilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.job = FolderCommit(options["path"], overwrite, "*", uuid.uuid4().hex[:12])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> FilesWritten:
        from pyspark import TaskContext
        ctx = TaskContext.get()
        mine = f"part-{ctx.partitionId():05d}-{ctx.taskAttemptId()}"
        fs, private = resolve(self.job.private)
        folders, last, out = set(), None, None
        try:
            for b in iterator:
                for folder, name, content in zip(*(b.column(c).to_pylist() for c in ("folder", "name", "content")),
                                                 strict=True):
                    at = f"{private}/{mine}/{folder}".rstrip("/")
                    if at not in folders:
                        fs.create_dir(at, recursive=True)
                        folders.add(at)
                    if last != (folder, name):
                        if out is not None:
                            out.close()
                        out, last = fs.open_output_stream(f"{at}/{name}", compression=None), (folder, name)
                    out.write((content or b"") + b"\n")
        finally:
            if out is not None:
                out.close()
        return FilesWritten([mine] if folders else [])

    def commit(self, messages: list) -> None:
        self.job.commit([n for m in messages if m for n in m.names])

    def abort(self, messages: list) -> None:
        self.job.abort()


class TextFilesSource(DataSource):
    """Texts as files below ``path``."""

    @classmethod
    def name(cls) -> str:
        return "text_files"

    def schema(self) -> str:
        return "folder string, name string, content binary"

    def writer(self, schema, overwrite: bool) -> TextFilesWriter:
        return TextFilesWriter(self.options, overwrite)


def reachable(root: str) -> bool:
    """Whether the store of ``root`` is one that tasks can write to."""
    try:
        resolve(root)
    except Exception:  # noqa: BLE001 - a scheme only Spark knows
        return False
    return True


def task_folders(root: str) -> list[str]:
    """The folders that ``write_files`` left below ``root``, one a task; none where anything
    else lies there."""
    if not reachable(root):
        return []
    fs, at = resolve(root)
    if fs.get_file_info(f"{at.rstrip('/')}/_SUCCESS").type == pafs.FileType.NotFound:
        return []
    found = [f for f in fs.get_file_info(pafs.FileSelector(at)) if not f.base_name.startswith(("_", "."))]
    ours = all(f.type == pafs.FileType.Directory and re.fullmatch(r"part-\d{5,}-\d+", f.base_name) for f in found)
    return sorted(f.path for f in found) if ours else []


def read_files(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """(path, value): the files in ``folders``, as Spark's text reader gives them whole.  Tasks list
    the folders and open the files, so the driver holds a name a folder and none of a file."""
    base, at = "file:" + local_path(root) if is_local_fs(root) else root, resolve(root)[1]
    each = max(1, -(-spark.sparkContext.defaultParallelism // len(folders)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = resolve(root)
        for task in (k for b in batches for k in b.column(0).to_pylist()):
            names = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(folders[task // each], recursive=True))
                           if f.type == pafs.FileType.File)
            paths, values, size = [], [], 0
            for name in names[task % each::each]:
                with fs.open_input_stream(name, compression=None) as file:
                    values.append(file.read())
                paths.append(base.rstrip("/") + name[len(at.rstrip("/")):])
                size += len(values[-1])
                if size > READ_BYTES or len(paths) >= READ_FILES:
                    yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(values, pa.binary())], names=["path", "value"])
                    paths, values, size = [], [], 0
            if paths:
                yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(values, pa.binary())], names=["path", "value"])

    ship_package(spark)
    n = len(folders) * each
    return spark.range(0, n, 1, n).mapInArrow(run, "path string, value binary").select(
        "path", F.col("value").cast("string").alias("value"))


def write_files(df: DataFrame, folder: Column, name: Column, text: str, root: str) -> None:
    """Each row's ``text`` and a line feed as ``<root>/part-*/<folder>/<name>``."""
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(TextFilesSource)
    rows = df.select(folder.alias("folder"), name.alias("name"), F.encode(text, "UTF-8").alias("content"))
    (rows.repartition("folder", "name").sortWithinPartitions("folder", "name")
     .write.format("text_files").mode("overwrite").save(root))
