"""tar.gz archives as a Python data source.

``spark.read.format("tar_members")``: one partition per archive, its members streamed in
order, so a task holds one batch of members, never an archive; there is no size limit on
archives.  Nothing is extracted or named by a member's path (``../x`` is just a string in a
row); directories, links and other non-regular members produce no row.  A damaged archive
fails its task.

``df.write.format("tar_members")``: one archive per non-empty partition, written to a
private folder and moved when the job commits, so a killed task leaves no archive behind.
"""

from __future__ import annotations

import io
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from ..session import ship_package
from .files import FolderCommit, listed, resolve

MEMBER_SCHEMA = "archive string, member string, content binary"
PATTERN = "*.tar.gz"
# Members of one Arrow batch: at most so many rows, closed at so many bytes.
MEMBER_BATCH = 256
MEMBER_BYTES = 8 << 20


@dataclass
class ArchivePartition(InputPartition):
    path: str


@dataclass
class ArchiveWritten(WriterCommitMessage):
    names: list


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.pattern = options["path"], options.get("pattern", PATTERN)

    def partitions(self) -> list[ArchivePartition]:
        # No archive: one partition without a path, which yields nothing.
        return [ArchivePartition(p) for p in listed(self.path, self.pattern)] or [ArchivePartition("")]

    def read(self, partition: ArchivePartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        members, contents, held = [], [], 0
        for member, content in stream_members(partition.path):
            members.append(member)
            contents.append(content)
            held += len(content)
            if len(members) >= MEMBER_BATCH or held >= MEMBER_BYTES:
                yield _batch(partition.path, members, contents)
                members, contents, held = [], [], 0
        if members:
            yield _batch(partition.path, members, contents)


def stream_members(path: str) -> Iterator[tuple[str, bytes]]:
    """(name, content) of the regular members of one archive, read once from front to back."""
    fs, at = resolve(path)
    with fs.open_input_stream(at, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|*") as tf:
        for m in tf:
            if m.isreg():
                yield m.name, tf.extractfile(m).read()
            tf.members = []  # the list of passed members would grow with the archive


def _batch(path: str, members: list[str], contents: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(members), pa.string()), pa.array(members, pa.string()), pa.array(contents, pa.binary())],
        names=["archive", "member", "content"])


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.job = FolderCommit(options["path"], overwrite, PATTERN, uuid.uuid4().hex[:12])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ArchiveWritten:
        from pyspark import TaskContext

        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():05d}-{ctx.taskAttemptId()}.tar.gz"
        fs, folder = resolve(self.job.private)
        out = tf = None
        try:
            for b in iterator:
                for member, content in zip(b.column("member").to_pylist(), b.column("content").to_pylist(), strict=True):
                    if tf is None:
                        fs.create_dir(folder, recursive=True)
                        out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                        tf = tarfile.open(fileobj=out, mode="w|gz")
                    info = tarfile.TarInfo(member)
                    info.size = len(content or b"")
                    tf.addfile(info, io.BytesIO(content or b""))
            if tf is not None:
                tf.close()
        finally:
            if out is not None:
                out.close()
        return ArchiveWritten([name] if tf is not None else [])

    def commit(self, messages: list) -> None:
        self.job.commit([n for m in messages if m for n in m.names])

    def abort(self, messages: list) -> None:
        self.job.abort()


class ArchiveSource(DataSource):
    """Members of tar.gz archives; options ``path`` and ``pattern`` (of archive names)."""

    @classmethod
    def name(cls) -> str:
        return "tar_members"

    def schema(self) -> str:
        return MEMBER_SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options, overwrite)


def _registered(spark: SparkSession) -> SparkSession:
    ship_package(spark)
    spark.dataSource.register(ArchiveSource)
    return spark


def read_archive_members(spark: SparkSession, root: str, pattern: str = PATTERN) -> DataFrame:
    """(archive, member, content): one row per regular file inside every archive below ``root``."""
    return _registered(spark).read.format("tar_members").option("pattern", pattern).load(root)


def write_archives(df: DataFrame, root: str, bucket_col: str, buckets: int, member_col: str = "member",
                   content_col: str = "content") -> None:
    """Write (member, content) rows as archives under ``root``, at most one for each of
    ``buckets`` partitions of ``bucket_col``."""
    _registered(df.sparkSession)
    rows = df.repartition(buckets, bucket_col).select(df[member_col].alias("member"), df[content_col].alias("content"))
    rows.selectExpr("CAST(NULL AS STRING) AS archive", "member", "content").write.format("tar_members").mode(
        "append").save(root)
