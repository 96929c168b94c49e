"""Exact top-k inner-product search as a Voronoi kNN join.

1. A few pivots split queries and data into Voronoi cells.
2. Summaries: per query cell its radius and size; per data cell its largest distance to
   the pivot and largest norm; per query cell the best guaranteed scores.  For a query q
   of cell i (pivot p, radius R) and any x:  p.x - R|x| <= q.x <= p.x + R|x|, so the k-th
   best lower bound over all data, theta_i, is reached by every query of the cell.
3. A data row is replicated to query cell i only if its upper bound reaches theta_i; whole
   data cells are dropped first by p_i.p_j + |p_i| e_j + R_i |x|max.
4. Each query cell is cut into blocks of queries and salts of data rows; such a piece is
   solved by one matrix product, and the pieces' best k per query are merged.

No answer is lost: the bounds hold for every row (with slack for rounding), ties included.
On data without clusters (random directions) the bounds cannot exclude anything and each
row goes to every query cell: at most PIVOTS x blocks copies of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prepare, staged

PIVOTS = 16
QUERY_BLOCK = 2048
SALT_ROWS = 4096

SOLVED = "query_id bigint, query_key bigint, vec_id bigint, score bigint"


def _pack(x: np.ndarray) -> list[bytes]:
    """Rows as int16 where all their components fit, else as float64."""
    small = (np.abs(x) < 32768).all(1) if x.size else np.ones(len(x), bool)
    return [(row.astype("<i2") if s else row.astype("<f8")).tobytes()
            for row, s in zip(x, small.tolist(), strict=True)]


def _unpack(rows: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim))
    for k, r in enumerate(rows):
        out[k] = np.frombuffer(r, "<i2" if len(r) == 2 * dim else "<f8")
    return out


def scaled_vectors(embeddings: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): usable vectors with each component x as floor(256 x)."""
    vec = embeddings[vec_col].cast("array<double>")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (embeddings.select(embeddings[id_col].cast("long").alias("vec_id"), vec.alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & fine))


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Padded with zeros to ``dim`` and scaled."""
    at = lists.offsets.to_numpy().astype(np.int64)
    flat = np.asarray(lists.values.to_numpy(zero_copy_only=False), float)
    lens = np.diff(at)
    out = np.zeros((len(lens), dim))
    row = np.repeat(np.arange(len(lens)), lens)
    col = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
    out[row, col] = np.floor(256 * flat[at[0]:at[-1]])
    return out


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: float64 while all partial sums stay below 2^53, Python
    integers beyond.  Products that exceed a long read as the nearest long."""
    if q.size and x.size and q.shape[1] * np.abs(q).max() * np.abs(x).max() >= 2.0 ** 53:
        whole = np.frompyfunc(int, 1, 1)
        return np.clip(whole(q) @ whole(x).T, -(1 << 63), (1 << 63) - 1)
    return q @ x.T


def solve(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray,
          k: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """Per query: position, best vec_ids and scores (ties to the smaller id), own id excluded."""
    order = np.argsort(x_ids, kind="stable")
    x_ids, x = x_ids[order], x[order]
    for lo in range(0, len(q_ids), 256):
        s = _products(q[lo:lo + 256], x)
        for j in range(len(s)):
            own = x_ids != q_ids[lo + j]
            ids, row = x_ids[own], s[j][own]
            if len(row) > k:
                edge = np.sort(np.partition(row, len(row) - k)[len(row) - k:])[0] if row.dtype != object \
                    else sorted(row)[len(row) - k]
                keep = row >= edge
                ids, row = ids[keep], row[keep]
            best = np.lexsort((ids, -row))[:k] if row.dtype != object else sorted(
                range(len(row)), key=lambda t: (-row[t], ids[t]))[:k]
            yield lo + j, [int(ids[b]) for b in best], [int(row[b]) for b in best]


def knn_join(embeddings: DataFrame, k: int = 5, is_query: str = "vec_id % 50 = 0", id_col: str = "vec_id",
             vec_col: str = "embedding", pivots: int = PIVOTS, query_block: int = QUERY_BLOCK,
             salt_rows: int = SALT_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of each query row
    (SQL condition on ``vec_id``) with all other rows.

    Vectors that are null or hold a null or non-finite component, and null ids, take no
    part.  A shorter vector counts as padded with zeros.  Rows of the query's own id are
    no candidates; candidates that repeat an id each count; equal query rows answer once.
    """
    spark = embeddings.sparkSession
    prepare(spark)
    rows = scaled_vectors(embeddings, id_col, vec_col)
    facts = rows.agg(F.max(F.size("vec")).alias("dim"), F.count(F.lit(1)).alias("n")).first()
    dim, n = int(facts["dim"] or 0), int(facts["n"])
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    # The pivots: a fixed number of rows, by hash.
    chosen = rows.orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id").limit(pivots).collect()
    piv = np.zeros((len(chosen), dim))
    for j, r in enumerate(chosen):
        piv[j, :len(r.vec)] = np.floor(256 * np.asarray(r.vec, float))
    piv_sq = (piv ** 2).sum(1)

    def assign(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in it:
            x = _matrix(b.column(1), dim)
            far = np.maximum(0, (x ** 2).sum(1)[:, None] + piv_sq - 2 * x @ piv.T)
            cell = far.argmin(1) if len(x) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(cell.astype(np.int32)),
                 pa.array(np.sqrt(far[np.arange(len(x)), cell])),
                 pa.array(np.linalg.norm(x, axis=1)), pa.array(_pack(x), pa.binary())],
                names=["vec_id", "is_query", "cell", "far", "norm", "vec"])

    cells = staged(rows.select("vec_id", "vec", F.coalesce(F.expr(is_query), F.lit(False)).alias("is_query"))
                   .mapInArrow(assign, "vec_id bigint, is_query boolean, cell int, far double, norm double, vec binary"),
                   "knn-cells")
    # Summaries: one row per cell.
    radius, count = np.full(len(piv), -1.0), np.zeros(len(piv), np.int64)
    for r in cells.where("is_query").groupBy("cell").agg(F.max("far").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radius[r.cell], count[r.cell] = r.r, r.n
    edge, reach = np.zeros(len(piv)), np.full(len(piv), -1.0)
    for r in cells.groupBy("cell").agg(F.max("far").alias("e"), F.max("norm").alias("m")).collect():
        edge[r.cell], reach[r.cell] = r.e, r.m
    live = np.flatnonzero(count > 0)

    def floors(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        """Best k + 1 lower bounds of this task per query cell."""
        ids, vals = [np.empty(0, np.int64) for _ in live], [np.empty(0) for _ in live]
        for b in it:
            own, norm = b.column(0).to_numpy(), b.column(1).to_numpy()
            low = _unpack(b.column(2).to_pylist(), dim) @ piv[live].T - norm[:, None] * radius[live]
            for c in range(len(live)):
                i, v = np.concatenate([ids[c], own]), np.concatenate([vals[c], low[:, c]])
                order = np.argsort(-v, kind="stable")
                i, v = i[order], v[order]
                first = np.sort(np.unique(i, return_index=True)[1])[:k + 1]  # distinct ids
                ids[c], vals[c] = i[first], v[first]
        for c in range(len(live)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids[c]), live[c], np.int32)), pa.array(ids[c]), pa.array(vals[c])],
                names=["cell", "vec_id", "low"])

    lows = (cells.select("vec_id", "norm", "vec").mapInArrow(floors, "cell int, vec_id bigint, low double")
            .groupBy("cell", "vec_id").agg(F.max("low").alias("low")))
    best = Window.partitionBy("cell").orderBy(F.col("low").desc(), "vec_id")
    theta = np.full(len(piv), -np.inf)
    for r in (lows.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).groupBy("cell")
              .agg(F.min("low").alias("low"), F.count(F.lit(1)).alias("n")).collect()):
        theta[r.cell] = r.low if r.n == k + 1 else -np.inf  # fewer: everything is needed
    slack = 1e-9 * (1 + np.abs(theta[np.isfinite(theta)]).max(initial=0)) + 1e-6
    top = piv @ piv.T + np.sqrt(piv_sq)[:, None] * edge + radius[:, None] * reach
    wanted = (top >= theta[:, None] - slack) & (count > 0)[:, None]  # query cell x data cell
    blocks = np.maximum(1, -(-count // query_block))
    salts = max(1, -(-n // salt_rows))

    def replicate(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in it:
            x, norm = _unpack(b.column(2).to_pylist(), dim), b.column(1).to_numpy()
            cell = b.column(3).to_numpy()
            need = (x @ piv.T + norm[:, None] * radius >= theta - slack) & wanted[:, cell].T
            for c in live:
                at = pa.array(np.flatnonzero(need[:, c]))
                part = [b.column(0).take(at), b.column(2).take(at), b.column(4).take(at)]
                for block in range(int(blocks[c])):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), c, np.int32)), pa.array(np.full(len(at), block, np.int32)),
                         part[2], part[0], part[1]], names=["cell", "block", "salt", "vec_id", "vec"])

    salt = F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(salts)).cast("int")
    data = cells.select("vec_id", "norm", "vec", "cell", salt.alias("salt")).mapInArrow(
        replicate, "cell int, block int, salt int, vec_id bigint, vec binary")
    per_cell = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("cell") + 1)
    asked = (cells.where("is_query")
             .select("cell", F.pmod(F.xxhash64("vec_id", F.lit(13)), per_cell).cast("int").alias("block"),
                     F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "vec_id", "vec"))

    def local(q: pa.Table, x: pa.Table) -> pa.Table:
        q_ids, q_rows = q["vec_id"].to_numpy(), q["vec"].to_pylist()
        once = list({(i, r): j for j, (i, r) in enumerate(zip(q_ids.tolist(), q_rows, strict=True))}.values())
        q_ids, q_rows = q_ids[once], [q_rows[j] for j in once]
        out: tuple[list, list, list, list] = ([], [], [], [])
        keys = [hash_row(r) for r in q_rows]
        for j, ids, scores in solve(q_ids, _unpack(q_rows, dim), x["vec_id"].to_numpy(),
                                    _unpack(x["vec"].to_pylist(), dim), k):
            out[0].extend([int(q_ids[j])] * len(ids))
            out[1].extend([keys[j]] * len(ids))
            out[2].extend(ids)
            out[3].extend(scores)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "query_key": pa.array(out[1], pa.int64()),
                         "vec_id": pa.array(out[2], pa.int64()), "score": pa.array(out[3], pa.int64())})

    piece = ["cell", "block", "salt"]
    found = asked.groupBy(*piece).cogroup(data.groupBy(*piece)).applyInArrow(local, SOLVED)
    final = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def hash_row(row: bytes) -> int:
    import zlib

    return zlib.crc32(row) << 31 ^ zlib.adler32(row)


def op3_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products for every query row of ``embeddings`` against all rows."""
    return knn_join(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.e, x.e)::BIGINT AS score
      FROM v q JOIN v x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""
