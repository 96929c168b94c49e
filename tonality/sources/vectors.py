"""Word-vector tables.

``vector_table`` stages the fixture vocabulary once per input (a do-once table in
the shared scratch folder, S9) and measures it: row count, dimension and the
longest word.  Those measured numbers are what the joins use to decide whether
the word side may be broadcast.

Binary files are read by ``binary_vectors.py``.  The text form is the usual word-vector text file: one word per line followed by
its components separated by single spaces; ``.gz`` files are read by suffix.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.broadcast import bounded_broadcast, broadcast_limit
from ..plans.staging import materialize_once, staged_path
from . import fixtures
from .tables import fingerprint, table_path

# Hash-relation overhead per broadcast row, generous.
ROW_OVERHEAD = 48
# Byte budget for the broadcast "hot word" side of a hybrid join (see VectorTable.join).
HOT_CONF_KEY = "tonality.hotWords.maxBytes"
HOT_DEFAULT = 64 * 1024 * 1024


@dataclass(frozen=True)
class VectorTable:
    """A staged (word, vec_id, vector) table; ``vec_id`` is the frequency rank
    (0 = most frequent word), which is what word-vector files are ordered by."""

    path: str
    n_words: int
    dim: int
    max_word_bytes: int

    def row_bytes(self, with_vectors: bool) -> int:
        return self.max_word_bytes + ROW_OVERHEAD + (4 * self.dim if with_vectors else 0)

    @property
    def word_bytes(self) -> int:
        return self.n_words * self.row_bytes(False)

    @property
    def vector_bytes(self) -> int:
        return self.n_words * self.row_bytes(True)

    def frame(self, spark: SparkSession) -> DataFrame:
        """word, vec_id, vector"""
        return spark.read.parquet(self.path)

    def words(self, spark: SparkSession) -> DataFrame:
        """The vocabulary keys, broadcast when their measured size allows."""
        return bounded_broadcast(self.frame(spark).select("word"), self.word_bytes)

    def vectors(self, spark: SparkSession) -> DataFrame:
        """word, vector, broadcast when their measured size allows."""
        return bounded_broadcast(self.frame(spark).select("word", "vector"), self.vector_bytes)

    def join(self, df: DataFrame, spark: SparkSession, how: str = "inner",
             with_vectors: bool = True, flag: str | None = None) -> DataFrame:
        """Join token rows to the vocabulary on ``word``.

        Whole side within the broadcast limit: one broadcast hash join.  Otherwise a
        hybrid that keeps hot words out of the shuffle: the ``H`` most frequent words
        (H bounded by the hot-word byte budget) are broadcast and joined in place, and
        only the remaining tokens -- those not among the hot words -- are shuffled
        against the rest of the vocabulary.  Frequent words are exactly the skewed
        keys, so the shuffle side carries neither the bulk of the tokens nor the hot
        keys.  ``how``: inner, left, left_semi or left_anti.  ``flag`` adds a column
        that is 1 on matched rows (null on unmatched rows of a left join).
        """
        cols = (["word", "vector"] if with_vectors else ["word"]) + (
            [F.lit(1).alias(flag)] if flag else [])
        whole = self.vector_bytes if with_vectors else self.word_bytes
        limit = broadcast_limit(spark)
        if whole <= limit:
            return df.join(F.broadcast(self.frame(spark).select(*cols)), "word", how)
        budget = int(spark.conf.get(HOT_CONF_KEY, str(HOT_DEFAULT)))
        n_hot = min(self.n_words, budget // self.row_bytes(with_vectors))
        table = self.frame(spark)
        hot = F.broadcast(table.where(F.col("vec_id") < n_hot).select(*cols))
        hot_words = F.broadcast(table.where(F.col("vec_id") < n_hot).select("word"))
        cold = table.where(F.col("vec_id") >= n_hot).select(*cols)
        rest = df.join(hot_words, "word", "left_anti")
        if how == "left_anti":
            return rest.join(cold, "word", "left_anti")
        hot_part = df.join(hot, "word", "left_semi" if how == "left_semi" else "inner")
        return hot_part.unionByName(rest.join(cold, "word", how))


    def n_hot(self, spark: SparkSession) -> int:
        """Words whose vectors fit the hot-word byte budget, most frequent first."""
        budget = int(spark.conf.get(HOT_CONF_KEY, str(HOT_DEFAULT)))
        return min(self.n_words, budget // self.row_bytes(True))

    def _hot_words(self, spark: SparkSession) -> DataFrame:
        # Bounded by the hot-word byte budget.
        return F.broadcast(self.frame(spark).where(F.col("vec_id") < self.n_hot(spark)).select("word").distinct())

    def hot_rows(self, spark: SparkSession) -> DataFrame:
        """All rows of the hot words (the whole table where it fits the budget)."""
        table = self.frame(spark)
        return table if self.n_hot(spark) >= self.n_words else table.join(self._hot_words(spark), "word", "left_semi")

    def attach_cold(self, df: DataFrame, spark: SparkSession, unknown: bool = False) -> DataFrame:
        """Adds ``cold`` array<float>: null on rows of hot words, else the row's vector by a
        shuffled join.  Where every word is hot, ``df`` as it is.  ``unknown``: keep rows of
        words without a vector (``cold`` null)."""
        if self.n_hot(spark) >= self.n_words:
            return df
        hot = self._hot_words(spark)
        cold = self.frame(spark).join(hot, "word", "left_anti").select("word", F.col("vector").alias("cold"))
        rest = df.join(hot, "word", "left_anti").join(cold, "word", "left" if unknown else "inner")
        return df.join(hot, "word", "left_semi").withColumn("cold", F.lit(None).cast("array<float>")) \
            .unionByName(rest)


_TABLES: dict[tuple, VectorTable] = {}


def measure(spark: SparkSession, path: str) -> VectorTable:
    row = spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.size("vector")).alias("dim"),
        F.max(F.octet_length("word")).alias("wmax")).first()
    return VectorTable(path, int(row["n"]), int(row["dim"] or 0), int(row["wmax"] or 0))


def vector_table(spark: SparkSession, sf_dir: str) -> VectorTable:
    """The staged fixture vocabulary for ``sf_dir`` (built on first use)."""
    ident = "|".join([os.path.abspath(sf_dir)] + [
        fingerprint(table_path(sf_dir, t)) for t in ("documents", "embeddings")])
    key = hashlib.sha1(ident.encode()).hexdigest()[:16]
    path = staged_path(spark, "word_vectors", key)
    memo = (path,)
    if memo not in _TABLES:
        materialize_once(spark, lambda: fixtures.word_vectors(spark, sf_dir), path)
        _TABLES[memo] = measure(spark, path)
    return _TABLES[memo]


def stage_vectors(spark: SparkSession, df: DataFrame, path: str) -> VectorTable:
    """Stage any (word, vector[, vec_id]) frame and measure it.

    Without ``vec_id`` the row order of the input (file order for a vector file,
    which lists words by frequency) becomes the rank."""
    if "vec_id" not in df.columns:
        from ..plans.ranking import global_ordinal

        # The file position is written down once, then numbered: it is data from there on.
        placed = materialize_once(
            spark, lambda: df.withColumn("_file_pos", F.monotonically_increasing_id()), path + "-placed")
        df = global_ordinal(placed, ["_file_pos"], out="vec_id").drop("_file_pos")
    materialize_once(spark, lambda: df.select("word", "vec_id", "vector"), path)
    return measure(spark, path)


def write_vector_text(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write ``word v1 v2 ...`` lines (floats printed by Spark's shortest form)."""
    line = F.concat_ws(" ", F.col("word"),
                       F.concat_ws(" ", F.transform("vector", lambda x: x.cast("string"))))
    writer = df.select(line.alias("value")).write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def read_vector_text(spark: SparkSession, path: str, dim: int | None = None) -> DataFrame:
    """word, vector (array<float>) from a text vector file (plain or .gz).

    A line of two whole numbers whose second is the vectors' length is the header and makes
    no row; empty lines are passed over.  Every other line must hold a word and as many
    components as the others (``dim``, or the header's, or the commonest number): a line
    that does not, or holds what is no number, raises with its file and its beginning.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.split(F.rtrim("value"), " ").alias("parts"))
    lines = lines.where(F.rtrim("value") != "")
    n = F.size("parts") - 1
    two = (n == 1) & F.forall("parts", lambda p: p.rlike("^[0-9]+$"))
    if dim is None:
        sizes = lines.groupBy(n.alias("n"), two.alias("two")).agg(
            F.count(F.lit(1)).alias("k"), F.max(F.element_at("parts", -1)).alias("last")).collect()  # a row a length
        best = max((r for r in sizes if not r.two), key=lambda r: (r.k, r.n), default=None)
        heads = [int(r["last"]) for r in sizes if r.two]
        dim = (heads[0] if len(heads) == 1 and best is not None and any(r.n == heads[0] for r in sizes if not r.two)
               else best.n if best is not None else 1)
    header = two & (F.element_at("parts", -1).try_cast("int") == dim) if dim != 1 else F.lit(False)
    word = F.element_at("parts", 1)
    comps = F.transform(F.slice("parts", 2, n), lambda x: x.try_cast("float"))
    wrong = (n != dim) | F.exists(comps, lambda x: x.isNull()) | (word == "")
    told = F.concat(F.lit(f"not a word and {dim} numbers in "), F.col("file"), F.lit(": "), F.left("value", F.lit(80)))
    checked = F.when(wrong, F.raise_error(told).cast("array<float>")).otherwise(comps)
    return lines.where(~header).select(word.alias("word"), checked.alias("vector"))
