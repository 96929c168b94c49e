"""Sequence-to-vector operators.

Vectors are never exploded into (token x dimension) rows: pooling is one
hash aggregate per text with a partial (map-side) phase, one buffer per dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.vectors import VectorTable

# Above this many dimensions pooling switches from one SQL aggregate per dimension
# to the ML Summarizer (a single typed aggregate buffer for the whole vector).
WIDE_DIM = 128


def sequence_vectors(trunc: DataFrame, vt: VectorTable, spark: SparkSession) -> DataFrame:
    """(doc_id, t, word, vector): vectors fetched only after truncation."""
    return vt.join(trunc, spark, "inner")


def mean_vector(vector_col: str, dim: int):
    """Aggregate expression: element-wise mean of fixed-length vectors, as array<double>."""
    if dim <= WIDE_DIM:
        # sum / count per dimension: one buffer per dimension plus one shared count
        # keeps the aggregate under the code generator's field limit.
        n = F.count(F.col(vector_col))
        return F.array(*[F.sum(F.col(vector_col)[i].cast("double")) / n for i in range(dim)])
    return whole_mean(vector_col)


def whole_mean(vector_col: str):
    """The same by one typed buffer for the whole vector: for few groups of many rows, where
    generated code with a sum per dimension costs more to compile than to run."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    return vector_to_array(Summarizer.mean(array_to_vector(F.col(vector_col))))


def pooled_vectors(trunc: DataFrame, vt: VectorTable, spark: SparkSession,
                   id_col: str = "doc_id") -> DataFrame:
    """(id, n, pooled): mean of the unmasked (truncated, known) word vectors."""
    seq = vt.join(trunc, spark, "inner")
    return seq.groupBy(id_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        mean_vector("vector", vt.dim).alias("pooled"))


def vector_dimension(wv: DataFrame) -> DataFrame:
    """min_dim, max_dim, n_words (P6); a table is usable only when min = max."""
    return wv.agg(F.min(F.size("vector")).cast("bigint").alias("min_dim"),
                  F.max(F.size("vector")).cast("bigint").alias("max_dim"),
                  F.count(F.lit(1)).alias("n_words"))


def round_array(col, digits: int = 6):
    c = F.col(col) if isinstance(col, str) else col
    return F.transform(c, lambda x: F.round(x.cast("double"), digits))
