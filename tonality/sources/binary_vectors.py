"""Binary word-vector files as a Python data source.

A file is a header line "<words> <dimension>", then for each word its UTF-8 bytes, a space
and the components as little-endian 32-bit floats; a line break may follow each record.
Records have no marks to find again from the middle, so planning walks their frames once
(word ends, fixed lengths, no vector is decoded) and notes a start every so many records: a
file is read by as many tasks.  ``.gz`` files cannot be entered in the middle and are one
task each.  Files of a folder are read in the order of their names; ``vec_id`` counts words
through them.  A header that does not hold, a cut-off record or bytes left over raise with
the file and the record.
"""

from __future__ import annotations

import gzip
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from ..session import ship_package
from .files import FolderCommit, listed, resolve

SCHEMA = "word string, vec_id bigint, vector array<float>"
PATTERN = "*.bin*"
# Bytes of records a task reads, and of one read.
SPLIT_BYTES = 64 << 20
READ_BYTES = 8 << 20
BATCH_ROWS = 1024
# No word is longer: what a damaged file may make a reader search through.
MAX_WORD = 1 << 16


class _Frames:
    """The records of an open file, front to back: ``next`` gives (start, word, vector bytes)."""

    def __init__(self, raw, path: str, start: int, record: int, dim: int):
        self.raw, self.path, self.dim, self.record = raw, path, dim, record
        self.buf, self.pos, self.base = b"", 0, start

    def _need(self, n: int) -> bool:
        while len(self.buf) - self.pos < n:
            more = self.raw.read(READ_BYTES)
            if not more:
                return False
            self.base += self.pos
            self.buf, self.pos = self.buf[self.pos:] + more, 0
        return True

    def at_end(self) -> bool:
        """Whether only line breaks are left."""
        while self._need(1):
            if self.buf[self.pos] != 10:
                return False
            self.pos += 1
        return True

    def next(self) -> tuple[int, bytes, bytes]:
        if self.at_end():
            raise ValueError(f"{self.path}: the file ends before record {self.record}")
        start = self.base + self.pos
        space, seen = -1, 0
        while space < 0:
            space = self.buf.find(b" ", self.pos + seen)
            seen = len(self.buf) - self.pos
            if space < 0 and (seen > MAX_WORD or not self._need(seen + 1)):
                raise ValueError(f"{self.path}: record {self.record} has no word")
        size = space + 1 - self.pos + 4 * self.dim
        if not self._need(size):
            raise ValueError(f"{self.path}: record {self.record} is cut off")
        frame = self.buf[self.pos:self.pos + size]
        self.pos += size
        self.record += 1
        word, vector = frame[:-4 * self.dim - 1], frame[-4 * self.dim:]
        return start, word, vector


def _open(path: str, start: int = 0):
    fs, at = resolve(path)
    if path.endswith(".gz"):
        return gzip.GzipFile(fileobj=fs.open_input_file(at))
    raw = fs.open_input_file(at)
    raw.seek(start)
    return raw


def _header(raw, path: str) -> tuple[int, int, int]:
    """(words, dimension, bytes of the header)."""
    line = b""
    while not line.endswith(b"\n"):
        c = raw.read(1)
        if not c or len(line) > 64:
            raise ValueError(f"{path}: no header of two numbers")
        line += c
    parts = line.split()
    if len(parts) != 2 or not all(p.isdigit() for p in parts) or int(parts[1]) < 1:
        raise ValueError(f"{path}: no header of two numbers")
    return int(parts[0]), int(parts[1]), len(line)


@dataclass
class VectorSplit(InputPartition):
    path: str
    start: int
    count: int
    first_id: int
    record: int
    dim: int
    last: bool


class BinaryVectorReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.pattern = options["path"], options.get("pattern", PATTERN)
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))

    def partitions(self) -> list[VectorSplit]:
        out, first, dims = [], 0, {}
        for path in listed(self.path, self.pattern):
            with _open(path) as raw:
                words, dim, at = _header(raw, path)
                dims[dim] = path
                if len(dims) > 1:
                    raise ValueError(f"files of different dimensions: {dims}")
                step = max(1, self.split_bytes // (4 * dim + 16))
                if path.endswith(".gz") or words <= step:
                    out.append(VectorSplit(path, at, words, first, 0, dim, True))
                else:
                    frames = _Frames(raw, path, at, 0, dim)
                    for record in range(words):
                        start, _, _ = frames.next()
                        if record % step == 0:
                            out.append(VectorSplit(path, start, min(step, words - record), first + record, record,
                                                   dim, record + step >= words))
                first += words
        return out or [VectorSplit("", 0, 0, 0, 0, 1, False)]

    def read(self, s: VectorSplit) -> Iterator[pa.RecordBatch]:
        if not s.path:
            return
        with _open(s.path, s.start) as raw:
            if s.path.endswith(".gz"):
                _header(raw, s.path)
            frames = _Frames(raw, s.path, s.start, s.record, s.dim)
            for done in range(0, s.count, BATCH_ROWS):
                words, vectors = [], []
                for _ in range(min(BATCH_ROWS, s.count - done)):
                    _, word, vector = frames.next()
                    words.append(word.decode("utf-8", "replace"))
                    vectors.append(vector)
                n = len(words)
                flat = pa.array(np.frombuffer(b"".join(vectors), "<f4"))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * s.dim, pa.int32()), flat)
                ids = pa.array(np.arange(n) + s.first_id + done, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(words), ids, lists], names=["word", "vec_id", "vector"])
            if s.last and not frames.at_end():
                raise ValueError(f"{s.path}: bytes are left after record {frames.record - 1}")


@dataclass
class VectorsWritten(WriterCommitMessage):
    names: list


class BinaryVectorWriter(DataSourceArrowWriter):
    """One file per non-empty partition, its records in the order of the rows."""

    def __init__(self, options: dict, overwrite: bool):
        self.job = FolderCommit(options["path"], overwrite, PATTERN, uuid.uuid4().hex[:12])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> VectorsWritten:
        from pyspark import TaskContext

        ctx, body, count, dim = TaskContext.get(), io.BytesIO(), 0, None
        for b in iterator:
            for word, vector in zip(b.column("word").to_pylist(), b.column("vector").to_pylist(), strict=True):
                if not word or " " in word or "\n" in word:
                    raise ValueError(f"the format cannot hold the word {word!r}")
                dim = len(vector) if dim is None else dim
                if len(vector) != dim:
                    raise ValueError(f"{word!r} has {len(vector)} components, not {dim}")
                body.write(word.encode() + b" " + np.asarray(vector, "<f4").tobytes() + b"\n")
                count += 1
        if not count:
            return VectorsWritten([])
        name = f"part-{ctx.partitionId():05d}-{ctx.taskAttemptId()}.bin"
        fs, folder = resolve(self.job.private)
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/{name}") as out:
            out.write(f"{count} {dim}\n".encode())
            out.write(body.getvalue())
        return VectorsWritten([name])

    def commit(self, messages: list) -> None:
        self.job.commit([n for m in messages if m for n in m.names])

    def abort(self, messages: list) -> None:
        self.job.abort()


class BinaryVectorSource(DataSource):
    """Word vectors in binary files; options ``path``, ``pattern`` and ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "binary_vectors"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BinaryVectorReader:
        return BinaryVectorReader(self.options)

    def writer(self, schema, overwrite: bool) -> BinaryVectorWriter:
        return BinaryVectorWriter(self.options, overwrite)


def _registered(spark: SparkSession) -> SparkSession:
    ship_package(spark)
    spark.dataSource.register(BinaryVectorSource)
    return spark


def read_vector_binary(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """word, vec_id (rank in file order), vector from binary vector files."""
    return _registered(spark).read.format("binary_vectors").option("splitBytes", split_bytes).load(path)


def write_vector_binary(df: DataFrame, path: str, files: int = 1) -> None:
    """Write (word, vec_id, vector) rows in the order of ``vec_id``, over at most ``files`` files
    (a file is put together in its task's memory)."""
    _registered(df.sparkSession)
    rows = df.select("word", F.col("vec_id").cast("bigint").alias("vec_id"), F.col("vector").cast("array<float>").alias("vector"))
    rows = rows.repartitionByRange(files, "vec_id").sortWithinPartitions("vec_id")
    rows.write.format("binary_vectors").mode("append").save(path)
