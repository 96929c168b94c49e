"""Embedding whitening by a blockwise QR and a bidiagonal qd solver.

1. n and the per-dimension sums S of the integer vectors, exact (decimal sums).
2. Every Arrow batch of centred rows folds into its task's R by a QR; the R of the tasks
   are folded ``FAN`` at a time until one is left.  R'R = n V, and no covariance is ever
   formed, so small directions keep their digits.
3. ``bidiagonal.right_singular`` on that one R (dimension x dimension): the principal
   directions and e = value / n.
4. One more pass measures the covariance of the whitened rows (per-batch means and centred
   scatters, combined pairwise by the same folds), a last one writes the rows.

Defined cases: vectors that are null, empty or hold a null, non-finite or huge entry
(|64 c| >= 2^51, where integers stop being exact doubles) take no part; neither do vectors
of another length than the commonest (ties: the longest).  Rows of null or repeated ids are
rows like any other.  Directions whose singular value is lost in rounding (constant or
dependent dimensions, fewer rows than dimensions) have ``whitened`` null and stay out of
``identity_error``.  ``deviation`` is null where it exceeds a long.  An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bidiagonal import EPS, right_singular
from .common import prepare, staged

#: Fixed values of the integer form x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Components returned, and blocks folded into one at a time.
COMPONENTS = 32
FAN = 32
#: Rows of one QR: bounds what a task holds to this many rows and one R.
BLOCK = 4096

BLOCKS = "block bigint, payload binary"


@dataclass
class Whitening:
    """The fitted transform: size is that of the model, not of the data."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    rank: int
    identity_error: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def kept(self) -> int:
        return min(self.vectors.shape[1], self.dim)


def usable_vectors(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, vec): vectors without null, non-finite or huge entries, as doubles."""
    limit = float(1 << 51) / SCALE
    fine = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(limit)))
    return (embeddings.select(embeddings[id_col].cast("long").alias("vec_id"),
                              embeddings[vec_col].cast("array<double>").alias("vec"))
            .where(F.col("vec").isNotNull() & (F.size("vec") > 0) & fine))


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """int64 x of the rows of an Arrow list column, all of length ``dim``."""
    at = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]]
    return np.floor(SCALE * flat.reshape(-1, dim)).astype(np.int64) + OFFSET


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: int64 where it fits, Python integers beyond."""
    top = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if top < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_deviations(x, n, sums) / n).astype(float)


def _squares(dev: np.ndarray) -> list[int | None]:
    top = int(np.abs(dev).max(initial=0))
    if dev.dtype == np.int64 and dev.shape[1] * top * top < 1 << 63:
        return (dev * dev).sum(1).tolist()
    exact = (dev.astype(object) ** 2).sum(1).tolist()
    return [v if v < 1 << 63 else None for v in exact]


def _fold_r(parts: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(parts), mode="r")


def _pack_r(r: np.ndarray) -> bytes:
    return np.ascontiguousarray(r, "<f8").tobytes()


def _merge_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows: [count, mean...] then the centred scatter; pairwise combination of two."""
    na, nb = a[0, 0], b[0, 0]
    if not na or not nb:
        return a if na else b
    delta = b[0, 1:] - a[0, 1:]
    out = np.empty_like(a)
    out[0, 0] = na + nb
    out[0, 1:] = a[0, 1:] + delta * (nb / (na + nb))
    out[1:, 1:] = a[1:, 1:] + b[1:, 1:] + np.outer(delta, delta) * (na * nb / (na + nb))
    out[1:, 0] = 0.0
    return out


def _moments(w: np.ndarray) -> np.ndarray:
    out = np.zeros((w.shape[1] + 1, w.shape[1] + 1))
    out[0, 0], out[0, 1:] = len(w), w.mean(0)
    c = w - out[0, 1:]
    out[1:, 1:] = c.T @ c
    return out


def _folded(blocks: DataFrame, width: int, fold: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """One matrix from (block, payload) rows: groups of ``FAN`` neighbours at a time."""

    def merge(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("block").to_pylist(), group.column("payload").to_pylist(), strict=True))
        done = fold([np.frombuffer(p, "<f8").reshape(-1, width) for _, p in rows])
        return pa.table({"block": pa.array([rows[0][0] // FAN], pa.int64()),
                         "payload": pa.array([_pack_r(done)], pa.binary())})

    blocks = staged(blocks, "whitening-blocks")
    top = blocks.agg(F.max("block")).first()[0]
    while top:
        groups = blocks.withColumn("g", F.floor(F.col("block") / FAN)).groupBy("g")
        blocks = staged(groups.applyInArrow(lambda t: merge(t.drop_columns("g")), BLOCKS), "whitening-blocks")
        top //= FAN
    rows = blocks.collect()  # at most one
    return np.frombuffer(rows[0]["payload"], "<f8").reshape(-1, width) if rows else None


def _task_blocks(fold: Callable[[list[np.ndarray]], np.ndarray],
                 first: Callable[[np.ndarray], np.ndarray], dim: int):
    """mapInArrow body: a task's rows, ``BLOCK`` at a time, folded into one payload."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state, held, size = None, [], 0

        def closed(state, held):
            part = first(np.vstack(held))
            return part if state is None else fold([state, part])

        for b in batches:
            if not b.num_rows:
                continue
            held.append(_matrix(b.column("vec"), dim))
            size += b.num_rows
            if size >= BLOCK:
                state, held, size = closed(state, held), [], 0
        if held:
            state = closed(state, held)
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([_pack_r(state)], pa.binary())],
                names=["block", "payload"])
    return run


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all rows of ``usable_vectors``; None when there are none."""
    prepare(vectors.sparkSession)
    size = F.size("vec").alias("d")
    dims = vectors.groupBy(size).count().orderBy(F.desc("count"), F.desc("d")).first()
    if dims is None:
        return None
    dim, n = int(dims["d"]), int(dims["count"])
    same = vectors.where(F.size("vec") == dim)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:  # at most 1024 rows of entries below 2^52: the sums fit a long
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(dim), pa.int32()), pa.array(_matrix(b.column("vec"), dim).sum(0))],
                    names=["i", "s"])

    got = (same.select("vec").mapInArrow(sums, "i int, s bigint").groupBy("i")
           .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())  # one row a dimension
    total = [int(r["s"]) for r in sorted(got, key=lambda r: r["i"])]

    blocks = same.select("vec").mapInArrow(
        _task_blocks(_fold_r, lambda x: _fold_r([_centred(x, n, total)]), dim), BLOCKS)
    r = _folded(blocks, dim, _fold_r)
    if r.shape[0] < dim:
        r = np.vstack([r, np.zeros((dim - r.shape[0], dim))])
    values, directions = right_singular(r)
    floor = (EPS * max(dim, 16)) ** 2 * float(values[0]) if len(values) else 0.0
    rank = int((values > floor).sum()) if values[0] > 0 else 0
    keep = min(components, dim)
    model = Whitening(n, total, values / n, directions[:, :keep], rank, 0.0)
    used = min(keep, rank)
    if used:
        def fold(parts: list[np.ndarray]) -> np.ndarray:
            out = parts[0]
            for p in parts[1:]:
                out = _merge_moments(out, p)
            return out

        w = _projector(model, used)
        moments = same.select("vec").mapInArrow(
            _task_blocks(fold, lambda x: _moments(_centred(x, n, total) @ w), dim), BLOCKS)
        m = _folded(moments, used + 1, fold)
        model.identity_error = float(np.abs(m[1:, 1:] / m[0, 0] - np.eye(used)).max())
    return model


def _projector(model: Whitening, used: int) -> np.ndarray:
    return model.vectors[:, :used] / np.sqrt(model.values[:used])


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened): one row a vector, the components as an array."""
    used = min(model.kept, model.rank)
    w, n, total, dim = _projector(model, used), model.n, model.sums, model.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            dev = _deviations(_matrix(b.column("vec"), dim), n, total)
            out = (dev / n).astype(float) @ w
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(out) + 1) * used, pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(_squares(dev), pa.int64()), lists],
                names=["vec_id", "deviation", "whitened"])

    return (vectors.where(F.size("vec") == dim)
            .mapInArrow(run, "vec_id bigint, deviation bigint, whitened array<double>"))


SCHEMA = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
          "identity_error double")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of ``embeddings`` whitened, a row for each of the first 32 components."""
    vectors = usable_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    model = fit_whitening(vectors)
    if model is None:
        return spark.createDataFrame([], SCHEMA)
    trace = math.fsum(model.values.tolist())
    share = [float(v) / trace if trace else None for v in model.values[:model.kept]]
    rows = whiten(vectors, model)
    component = F.explode(F.sequence(F.lit(1), F.lit(model.kept))).alias("component")
    return (rows.select("vec_id", "deviation", "whitened", component)
            .select("vec_id", "component", F.lit(model.n).cast("bigint").alias("n"), "deviation",
                    F.get("whitened", F.col("component") - 1).alias("whitened"),
                    F.get(F.array(*[F.lit(s).cast("double") for s in share]), F.col("component") - 1)
                    .alias("explained"),
                    F.lit(model.identity_error).alias("identity_error")))
