"""Vectors fetched inside tasks (J2 for whole sequences).

A sequence of 256 vectors is some fifty times as wide as its words, so sequences travel as
words (``words``) through joins, windows, checkpoints and training tables and become vectors
where they are used: in the Arrow task that computes with them, from a broadcast table of the
most frequent words (bounded by ``tonality.hotWords.maxBytes``).  Where the vocabulary is
larger, the other words' vectors come by a shuffled join and travel in ``cold``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalised_text
from ..plans.broadcast import broadcast_limit
from ..sources import fixtures
from ..sources.vectors import VectorTable

# Most bytes of vectors in an Arrow batch given back to Spark.
OUT_BYTES = 8 << 20
_SEQ = pa.list_(pa.list_(pa.float32()))


class Lookup:
    """Words -> vectors, from the broadcast table: ``index`` and ``matrix`` for words with one
    vector of full length, ``others`` for the rest (a list of vectors or nulls a word)."""

    def __init__(self, table, dim: int, zeros: bool):
        self.table, self.dim, self.zeros = table, dim, zeros

    def sequence(self, words, cold=None):
        """[n, dim] vectors of the words in order; a list where an entry is null or ragged.
        ``cold``: per word the vector that came by the join, or None.  Words are known ones;
        with ``zeros`` others may be among them, which take a zero vector, as do null ones."""
        index, matrix, others = self.table.value
        if words is None:
            return np.zeros((0, self.dim), np.float32)
        at = [index.get(w, -1) for w in words]
        if not at or min(at) >= 0:
            return matrix[at] if at else np.zeros((0, self.dim), np.float32)
        out = []
        for k, (i, w) in enumerate(zip(at, words, strict=True)):
            if i >= 0:
                found = [matrix[i]]
            elif w in others:
                found = others[w]
            else:
                found = [None if cold is None else cold[k]]
            out += [np.zeros(self.dim, np.float32) if v is None and self.zeros else v for v in found]
        if all(v is not None and len(v) == self.dim and not any(x is None for x in v) for v in out):
            return np.asarray(out, np.float32).reshape(-1, self.dim)
        return out

    def batch(self, batch: pa.RecordBatch) -> list:
        words = batch.column("words").to_pylist()
        cold = batch.column("cold").to_pylist() if "cold" in batch.schema.names else [None] * len(words)
        return [self.sequence(w, c) for w, c in zip(words, cold, strict=True)]


_BROADCASTS: dict[tuple, object] = {}


def lookup(vt: VectorTable, spark: SparkSession, zeros: bool = False) -> Lookup:
    """The look-up of a table's most frequent words (collected once, within the byte budget)."""
    key = (spark.sparkContext.applicationId, vt.path, vt.n_hot(spark))
    if key not in _BROADCASTS:
        rows = vt.hot_rows(spark).select("word", "vector").orderBy("word", "vector").toArrow()
        words, vectors = rows.column("word").to_pylist(), rows.column("vector").combine_chunks()
        index, others, at = {}, {}, []
        again = {a for a, b in zip(words, words[1:]) if a == b}
        sizes = np.diff(vectors.offsets.to_numpy()) if len(words) else []
        holes = vectors.null_count or vectors.values.null_count
        for k, w in enumerate(words):
            if w in again or sizes[k] != vt.dim or (holes and (v := vectors[k].as_py()) is None) or (
                    holes and None in v):
                others.setdefault(w, []).append(vectors[k].as_py())
            else:
                index[w] = len(at)
                at.append(k)
        starts = vectors.offsets.to_numpy()[at] if at else np.zeros(0, np.int64)
        flat = vectors.values.to_numpy(zero_copy_only=False)
        matrix = (flat[starts[:, None] + np.arange(vt.dim)] if at else np.zeros((0, vt.dim))).astype(np.float32)
        _BROADCASTS[key] = spark.sparkContext.broadcast((index, matrix, others))
    return Lookup(_BROADCASTS[key], vt.dim, zeros)


def doc_words(steps: DataFrame, vt: VectorTable, spark: SparkSession, id_col: str = "doc_id",
              unknown: bool = False) -> DataFrame:
    """(id, words[, cold]): the words of (id, t, word) rows in step order; ``unknown``: the rows
    may hold words without a vector.  ``cold`` is there where the table is larger than its
    broadcast part."""
    rows = vt.attach_cold(steps.select(id_col, "t", "word"), spark, unknown)
    parts = [c for c in ("t", "word", "cold") if c in rows.columns]
    packed = rows.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct(*parts))).alias("_s"))
    return packed.select(id_col, F.transform("_s", lambda s: s["word"]).alias("words"), *(
        [F.transform("_s", lambda s: s["cold"]).alias("cold")] if "cold" in parts else []))


_VOCABULARIES: dict[tuple, object] = {}


def _vocabulary(vt: VectorTable, spark: SparkSession):
    """The number of rows of each word of a table, broadcast; callers keep to ``broadcast_limit``."""
    key = (spark.sparkContext.applicationId, vt.path, vt.n_words)
    if key not in _VOCABULARIES:
        rows = vt.frame(spark).groupBy("word").count().toArrow()
        words, n = (rows.column(c).to_numpy().tolist() for c in ("word", "count"))
        _VOCABULARIES[key] = spark.sparkContext.broadcast(dict(zip(words, n, strict=True)))
    return _VOCABULARIES[key]


def _first_words(vocabulary, max_len: int | None, every: bool):
    """Arrow batches of (id, normalised text) -> (id, n_tokens, n_known, pos, words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = vocabulary.value
        for b in batches:
            parts = pc.split_pattern(b.column(1).cast(pa.large_string()), " ")
            sizes = pc.fill_null(pc.list_value_length(parts), 0).to_numpy().astype(np.int64)
            pieces = parts.flatten().dictionary_encode()
            which, names = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary
            words = names.to_numpy(zero_copy_only=False).tolist()
            is_word = np.fromiter(map(bool, words), bool, len(words))[which]
            # A token counts once for each row of its word, as in a join.
            times = np.fromiter((known_words.get(w, 0) for w in words), np.int64, len(words))[which]
            known = (times > 0) & is_word
            row = np.repeat(np.arange(len(sizes)), sizes)

            def total(x: np.ndarray) -> pa.Array:
                return pa.array(np.bincount(row, x, minlength=len(sizes)).astype(np.int64))

            taken = np.flatnonzero(is_word if every else known)
            n = np.bincount(row[taken], minlength=len(sizes))
            nth = np.arange(len(taken)) - np.repeat(np.cumsum(n) - n, n)
            if max_len is not None:
                taken, n = taken[nth < max_len], np.minimum(n, max_len)
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            pos = taken - (np.cumsum(sizes) - sizes)[row[taken]]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), total(np.maximum(times, 1) * is_word), total(times * is_word),
                 pa.ListArray.from_arrays(offsets, pa.array(pos.astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, names.take(pa.array(which[taken])).cast(pa.string()))],
                names=[b.schema.names[0], "n_tokens", "n_known", "pos", "words"])
    return run


def token_words(toks: DataFrame, vt: VectorTable, spark: SparkSession, max_len: int | None,
                id_col: str = "doc_id", every: bool = False) -> DataFrame:
    """``text_words`` from (id, pos, word) rows, which are joined to the vocabulary."""
    from . import tokens as tok

    counts = tok.known_counts(toks.select(id_col).distinct(), toks, vt, spark, id_col)
    steps = tok.first_tokens(toks, max_len, id_col) if every else tok.truncated_tokens(toks, vt, spark, max_len, id_col)
    words = doc_words(steps, vt, spark, id_col, unknown=every).withColumnRenamed(id_col, "_id")
    return counts.join(words, F.col(id_col).eqNullSafe(F.col("_id")), "left").drop("_id")


def text_words(docs: DataFrame, vt: VectorTable, spark: SparkSession, max_len: int | None,
               id_col: str = "doc_id", text_col: str = "text", every: bool = False, vectors: bool = True) -> DataFrame:
    """(id, n_tokens, n_known, words[, cold]): a row an id of ``docs`` with its numbers of tokens
    and known tokens and its first ``max_len`` known words (``every``: tokens) in order; ``cold`` as in ``doc_words``, unless ``vectors`` is False.

    The words of a text are picked in the task that reads it, so a row a text is shuffled
    and not a row a token; texts of equal id are one text, word by word.  The vocabulary is
    broadcast within ``broadcast_limit``; above it the tokens are joined.
    """
    if vt.word_bytes > broadcast_limit(spark):
        toks = fixtures.tokens_of(docs.select(id_col, text_col), id_col, text_col)
        return token_words(toks, vt, spark, max_len, id_col, every)
    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(id_col, normalised_text(text_col).alias("_text")).mapInArrow(
        _first_words(_vocabulary(vt, spark), max_len, every),
        f"`{id_col}` {kind}, n_tokens bigint, n_known bigint, pos array<int>, words array<string>")
    # ``pos`` orders the words of texts that share an id.
    both = F.array_sort(F.flatten(F.transform("_t", lambda t: F.arrays_zip(t["pos"], t["words"]))))
    merged = F.transform(both if max_len is None else F.slice(both, 1, max_len), lambda s: s["words"])
    out = found.groupBy(id_col).agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.collect_list(F.struct("pos", "words")).alias("_t")).select(
            id_col, "n_tokens", "n_known", F.when(F.size("_t") == 1, F.col("_t")[0]["words"]).otherwise(merged).alias("words"))
    if not vectors or vt.n_hot(spark) >= vt.n_words:
        return out
    steps = out.select(id_col, F.posexplode("words").alias("t", "word"))
    return out.drop("words").join(doc_words(steps, vt, spark, id_col, unknown=every), id_col, "left")


def _arrow(seqs: list, dim: int) -> pa.Array:
    if any(isinstance(s, list) for s in seqs):
        return pa.array([[None if v is None else list(v) for v in s] for s in seqs], _SEQ)
    steps = np.cumsum([0, *map(len, seqs)]).astype(np.int32)
    flat = np.concatenate(seqs).ravel() if seqs else np.zeros(0, np.float32)
    vectors = pa.ListArray.from_arrays(pa.array(np.arange(steps[-1] + 1, dtype=np.int32) * dim), pa.array(flat))
    return pa.ListArray.from_arrays(pa.array(steps), vectors)


def with_vectors(df: DataFrame, vt: VectorTable, spark: SparkSession, zeros: bool = False) -> DataFrame:
    """``seq`` (array of vectors, empty for null words) in place of ``words`` and ``cold``."""
    look, dim = lookup(vt, spark, zeros), vt.dim
    kept = [f for f in df.schema.fields if f.name not in ("words", "cold")]
    names = [f.name for f in kept]
    most = max(1, OUT_BYTES // (256 * 4 * max(dim, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, most):
                b = whole.slice(s, most)
                yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), _arrow(look.batch(b), dim)],
                                                 names=[*names, "seq"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "seq array<array<float>>"])
    return df.mapInArrow(run, schema)


def _mean(seq, dim: int) -> list | np.ndarray | None:
    """Mean of a sequence's vectors as ``vectors.mean_vector`` forms it: summed in step order,
    entries that are null left out of a sum, null vectors out of the number."""
    if not isinstance(seq, list):
        return seq.astype(np.float64).sum(axis=0) / len(seq)
    whole = [v for v in seq if v is not None]
    columns = [[float(v[i]) for v in whole if v[i] is not None] for i in range(dim)]
    return [sum(c) / len(whole) if c else None for c in columns]


def pooled_words(df: DataFrame, vt: VectorTable, spark: SparkSession, id_col: str = "doc_id") -> DataFrame:
    """(id, n, pooled) of ``text_words`` rows with a known word: as ``vectors.pooled_vectors`` of
    their tokens, the vectors being fetched and added up in one task."""
    look, dim = lookup(vt, spark), vt.dim
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            index, matrix, _ = look.table.value
            words = b.column("words")
            sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy().astype(np.int64)
            ends = np.cumsum(sizes)
            flat = words.flatten().dictionary_encode()
            names = flat.dictionary.to_pylist()
            # Null words and words that are not in the table's index have no place in it.
            places = np.fromiter((index.get(w, -1) for w in names), np.int64, len(names))
            at = np.append(places, -1)[pc.fill_null(flat.indices, len(names)).to_numpy()]
            n, pooled = [], []
            for k, (i, j) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), strict=True)):
                if i < j and at[i:j].min() >= 0:
                    seq = matrix[at[i:j]]
                else:
                    seq = look.sequence(words[k].as_py(), b.column("cold")[k].as_py() if "cold" in b.schema.names else None)
                n.append(len(seq))
                pooled.append(_mean(seq, dim) if len(seq) else None)
            rows = pa.RecordBatch.from_arrays([b.column(id_col), pa.array(n, pa.int64()), pa.array(
                pooled, pa.list_(pa.float64()))], names=[id_col, "n", "pooled"])
            yield rows.filter(pa.array([k > 0 for k in n], pa.bool_()))

    columns = [id_col, "words", *(["cold"] if "cold" in df.columns else [])]
    return df.select(*columns).mapInArrow(run, f"`{id_col}` {kind}, n bigint, pooled array<double>")
