"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) P(word | class).

* Tokens: words of a text, lower-cased (A-Z), then one end.
* Classes: the end, the most frequent words (a class each), and clusters of all other
  words.  A word's cluster follows from its last two letters; those endings are clustered
  by which endings stand before and after them in the training texts.
* P(class | history): softmax over the classes, features being the word before (n-gram of
  order 2), the hashed pair of the two words before (order 3) and the word before the last
  one alone (skip).  Rarer words enter as features by their class.
* P(word | class): counts smoothed by 0.5, one unseen word per class; counts are exact
  over all training texts, words being keyed by a 64-bit hash.

Training is distributed: in each round every task runs minibatch gradient steps (per-row
AdaGrad) over its texts from the common parameters, and the rows of the parameter tables
are averaged, weighted by how often the task updated them, in two shuffles of row blocks.
The rounds deal the training texts among them, so each text is used once.

Scoring is one pass: a bounded table of the most frequent words is broadcast; counts of
the remaining (cold) words are joined by word hash and summed per text.  Cold words are
rare by construction, so this join has no hot key.
"""

from __future__ import annotations

import functools
import itertools
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_of_id, prepare, staged, texts

SINGLES, CLUSTERS = 31, 16
CLASSES = 1 + SINGLES + CLUSTERS
ATOMS = 1024
#: Words that are features of their own; rows of the hashed pair table.
FEATURE_WORDS, PAIR_ROWS = 4000, 8192
WORD_ROWS = FEATURE_WORDS + CLASSES + 1  # and the start of a text
ROWS = 2 * WORD_ROWS + PAIR_ROWS
#: Words whose counts are broadcast (24 bytes each).
HOT_WORDS = 500_000
BATCH, RATE, ROUNDS = 4096, 0.4, 2
#: Rows of counts given back at a time; words remembered by a task.
COUNT_CHUNK, MEMO_WORDS = 100_000, 400_000
BLOCK_ROWS = 1024
END = -1  # key of the end token

_TRAIL = b".,;:!?)\"'"


def ending(word: bytes) -> int:
    """Atom of a word: its last two bytes without trailing marks; 0 is the end token."""
    return 1 + zlib.crc32((word.rstrip(_TRAIL) or word)[-2:]) % (ATOMS - 1)


@functools.cache
def _atoms_of_bytes() -> tuple[np.ndarray, np.ndarray]:
    """Atoms of all single bytes and of all pairs of bytes (the first times 256, and the second)."""
    one = [1 + zlib.crc32(bytes([a])) % (ATOMS - 1) for a in range(256)]
    two = [1 + zlib.crc32(bytes([a, b])) % (ATOMS - 1) for a in range(256) for b in range(256)]
    return np.array(one, np.int64), np.array(two, np.int64)


def endings(words: pa.Array) -> np.ndarray:
    """``ending`` of each word of a string array, none null or empty."""
    bare = pc.ascii_rtrim(words, _TRAIL.decode())
    bare = pc.if_else(pc.equal(pc.binary_length(bare), 0), words, bare)
    if not len(bare):
        return np.zeros(0, np.int64)
    offsets = np.frombuffer(bare.buffers()[1], np.int32)[bare.offset:bare.offset + len(bare) + 1].astype(np.int64)
    data = np.frombuffer(bare.buffers()[2], np.uint8)
    last = data[offsets[1:] - 1].astype(np.int64)
    one, two = _atoms_of_bytes()
    pair = np.diff(offsets) > 1
    return np.where(pair, two[data[np.where(pair, offsets[1:] - 2, 0)].astype(np.int64) * 256 + last], one[last])


def _as_strings(column: pa.Array) -> pa.Array:
    """A binary array under the string type, its bytes unchecked."""
    return pa.Array.from_buffers(pa.string(), len(column), column.buffers(), column.null_count, column.offset)


def _as_bytes(column: pa.Array) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(column), column.buffers(), column.null_count, column.offset)


class Reader:
    """Texts as local word numbers; per number the word's hash and atom.  0: the end."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.local: dict[bytes, int] = {}
        self.keys = np.array([END], np.int64)
        self.atoms = np.zeros(1, np.int64)
        self.looked_up: tuple[np.ndarray, ...] = ()

    def full(self) -> bool:
        return len(self.keys) > MEMO_WORDS

    def read(self, batch: pa.Array | list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all texts in a row, each closed by the end; length of each).

        Arrow cuts the texts (binary) into words and numbers them; Python sees each distinct
        word of a batch once."""
        from xxhash import xxh3_64_intdigest

        if self.full():
            self.clear()
        if not isinstance(batch, pa.Array) or batch.type != pa.binary():
            batch = pa.array(batch, pa.binary()) if not isinstance(batch, pa.Array) else batch.cast(pa.binary())
        # The kernels go by bytes, so texts need not be valid UTF-8.
        parts = pc.ascii_split_whitespace(pc.ascii_lower(_as_strings(batch)))
        sizes = pc.fill_null(pc.list_value_length(parts), 0).to_numpy().astype(np.int64)
        pieces = parts.flatten().dictionary_encode()
        which, names = pieces.indices.to_numpy(), pieces.dictionary
        # White space at an end of a text, and no text, give an empty piece.
        if (empty := pc.index(names, pa.scalar("", names.type)).as_py()) >= 0:
            none = np.flatnonzero(which == empty)
            row = np.searchsorted(np.cumsum(sizes), none, side="right")
            sizes -= np.bincount(row, minlength=len(sizes))
            which = np.delete(which, none)
        words = _as_bytes(names).to_numpy(zero_copy_only=False).tolist()
        if empty >= 0:
            words[empty] = None  # stands nowhere any more
        number = np.fromiter(map(self.local.get, words, itertools.repeat(-1)), np.int32, len(words))
        if empty >= 0:
            number[empty] = 0
        at = np.flatnonzero(number < 0)
        fresh = [words[k] for k in at.tolist()]
        number[at] = np.arange(len(self.keys), len(self.keys) + len(fresh))
        self.local.update(zip(fresh, number[at].tolist(), strict=True))
        keys = np.fromiter(map(xxh3_64_intdigest, fresh), np.uint64, len(fresh))
        self.keys = np.concatenate([self.keys, keys.view(np.int64)])
        self.atoms = np.concatenate([self.atoms, endings(names.take(pa.array(at)))])
        lens = sizes + 1
        out = np.zeros(int(lens.sum()), np.int32)
        inner = np.ones(len(out), bool)
        inner[np.cumsum(lens) - 1] = False
        out[inner] = number[which]
        return out, lens

    def look_up(self, model: Model) -> tuple[np.ndarray, ...]:
        """``model.look_up`` of all numbers so far, each word looked up once."""
        known = len(self.looked_up[0]) if self.looked_up else 0
        new = model.look_up(self.keys[known:], self.atoms[known:])
        self.looked_up = tuple(map(np.concatenate, zip(self.looked_up, new, strict=True))) if known else new
        return self.looked_up


def _count_rows(rows: DataFrame) -> DataFrame:
    """kind 0: (word, atom, n); kind 1: (atom pair, -, n); partial sums of tasks."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        reader, times, pairs = Reader(), np.zeros(0, np.int64), np.zeros(ATOMS * ATOMS, np.int64)

        def batch(kind: int, key, atom, n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), kind, np.int32)), pa.array(np.asarray(key, np.int64)),
                 pa.array(np.asarray(atom, np.int32)), pa.array(np.asarray(n, np.int64))], names=["kind", "key", "atom", "n"])

        def counted() -> Iterable[pa.RecordBatch]:
            met = np.flatnonzero(times)
            for lo in range(0, len(met), COUNT_CHUNK):
                at = met[lo:lo + COUNT_CHUNK]
                yield batch(0, reader.keys[at], reader.atoms[at], times[at])

        for b in it:
            if reader.full():
                yield from counted()
                reader.clear()
                times = np.zeros(0, np.int64)
            numbers, lens = reader.read(b.column(1))
            atom = reader.atoms[numbers]
            now = np.bincount(numbers, minlength=len(reader.keys))
            now[:len(times)] += times
            times = now
            before = np.concatenate([[0], atom[:-1]])  # the end stands before the first word
            pairs += np.bincount(before * ATOMS + atom, minlength=ATOMS * ATOMS)
        yield from counted()
        seen = np.flatnonzero(pairs)
        if len(seen):
            yield batch(1, seen, np.zeros(len(seen)), pairs[seen])

    return rows.mapInArrow(run, "kind int, key bigint, atom int, n bigint")


def cluster_atoms(pairs: np.ndarray, clusters: int = CLUSTERS, turns: int = 15) -> np.ndarray:
    """Cluster of each atom by its neighbours' distribution (spherical k-means, weighted)."""
    weight = pairs.sum(0).astype(float)
    left, right = pairs.T.astype(float), pairs.astype(float)
    x = np.concatenate([np.sqrt(m / np.maximum(1, m.sum(1, keepdims=True))) for m in (left, right)], 1)
    x /= np.maximum(1e-9, np.linalg.norm(x, axis=1, keepdims=True))
    seeds = [int(weight.argmax())]
    near = x @ x[seeds[0]]
    for _ in range(clusters - 1):  # far from all before, and frequent
        seeds.append(int(((1 - near) * np.sqrt(weight)).argmax()))
        near = np.maximum(near, x @ x[seeds[-1]])
    centre = x[seeds]
    for _ in range(turns):
        own = (x @ centre.T).argmax(1)
        for c in range(clusters):
            if weight[own == c].sum():
                m = (x[own == c] * weight[own == c, None]).sum(0)
                centre[c] = m / max(1e-9, np.linalg.norm(m))
    return (x @ centre.T).argmax(1)


class Model:
    """Everything a scoring task needs; sizes are fixed but for the bounded hot table."""

    def __init__(self, hot_keys, hot_counts, hot_atoms, atom_totals, atom_types, pairs, train_tokens: int, types: int):
        by = np.lexsort((hot_keys, -hot_counts))
        keys, counts, atoms = hot_keys[by], hot_counts[by], hot_atoms[by]
        self.cluster = cluster_atoms(pairs)
        words = np.flatnonzero(keys != END)
        single = words[:SINGLES]
        cls = (1 + SINGLES + self.cluster[atoms]).astype(np.int16)
        cls[single] = 1 + np.arange(len(single))
        cls[keys == END] = 0
        rank = np.arange(len(keys))
        feature = np.where(rank < FEATURE_WORDS, rank, FEATURE_WORDS + cls).astype(np.int32)
        n_class, v_class = np.zeros(CLASSES), np.zeros(CLASSES)
        np.add.at(n_class, 1 + SINGLES + self.cluster[1:], atom_totals[1:])
        np.add.at(v_class, 1 + SINGLES + self.cluster[1:], atom_types[1:])
        for k in single:  # their words leave the cluster they would be in
            home = 1 + SINGLES + self.cluster[atoms[k]]
            n_class[home] -= counts[k]
            v_class[home] -= 1
            n_class[cls[k]] = counts[k]
        n_class[0] = atom_totals[0]
        self.alone = np.zeros(CLASSES, bool)
        self.alone[:1 + len(single)] = True
        self.log_rest = np.where(self.alone, 0, np.log10(n_class + 0.5 * (v_class + 1)))
        self.bias = np.log((n_class + 0.5) / (n_class + 0.5).sum()).astype(np.float32)
        self.bias[1 + len(single):1 + SINGLES] = -30  # classes without a word
        order = np.argsort(keys)
        self.keys, self.classes, self.features = keys[order], cls[order], feature[order]
        self.log_count = np.log10(counts[order] + 0.5)
        self.train_tokens = train_tokens
        self.log_all = math.log10(train_tokens + 0.5 * (types + 1))
        self.w = np.zeros((ROWS, CLASSES), np.float32)

    def look_up(self, keys: np.ndarray, atoms: np.ndarray):
        """Per word: hot?, log10(count + 0.5) if hot, class, feature."""
        at, order = np.empty(len(keys), np.int64), np.argsort(keys)  # keys in order are found faster
        at[order] = np.minimum(np.searchsorted(self.keys, keys[order]), max(0, len(self.keys) - 1))
        hot = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        other = 1 + SINGLES + self.cluster[atoms]
        if not len(self.keys):
            cls = np.where(keys == END, 0, other)
            return hot, np.zeros(len(keys)), cls, FEATURE_WORDS + cls
        cls = np.where(hot, self.classes[at], np.where(keys == END, 0, other))
        return hot, np.where(hot, self.log_count[at], 0), cls, np.where(hot, self.features[at], FEATURE_WORDS + cls)


def history(feature: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Rows of the parameter table for every token: [tokens, 3]."""
    start = WORD_ROWS - 1
    first = np.cumsum(lens) - lens
    one = np.concatenate([[start], feature[:-1]])
    one[first] = start
    two = np.concatenate([[start], one[:-1]])
    two[first] = start
    pair = ((one.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + two.astype(np.uint64) * np.uint64(
        0xC2B2AE3D27D4EB4F)) >> np.uint64(51)).astype(np.int64) % PAIR_ROWS
    return np.stack([one, WORD_ROWS + two, 2 * WORD_ROWS + pair], 1)


def _logits(model: Model, w: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return model.bias + w[rows[:, 0]] + w[rows[:, 1]] + w[rows[:, 2]]


def _train_round(model: Model, rows: DataFrame) -> None:
    """One round of local gradient steps and weighted averaging of the parameter rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    tasks = max(1, rows.select("doc_id").rdd.getNumPartitions())
    salts = math.isqrt(tasks - 1) + 1

    def run(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        model, reader = shared.value, Reader()
        w, power, used = model.w.copy(), np.full(ROWS, 1e-6, np.float32), np.zeros(ROWS, np.int64)
        for b in it:
            numbers, lens = reader.read(b.column(1))
            _, _, cls, feature = reader.look_up(model)
            rows, want = history(feature[numbers], lens), cls[numbers]
            for lo in range(0, len(want), BATCH):
                r, y = rows[lo:lo + BATCH], want[lo:lo + BATCH]
                z = _logits(model, w, r)
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(y)), y] -= 1
                at = r.T.ravel()  # the three tables share no row
                order = np.argsort(at, kind="stable")
                first = np.flatnonzero(np.diff(at[order], prepend=-1))
                g = np.add.reduceat(p[order % len(y)], first, axis=0)
                row, n = at[order][first], np.diff(first, append=len(order))
                g /= np.sqrt(n)[:, None].astype(np.float32)
                power[row] += (g * g).mean(1)
                w[row] -= RATE * g / np.sqrt(power[row])[:, None]
                used[row] += n
        if used.any():
            salt = TaskContext.get().partitionId() % salts
            for k in range(0, ROWS, BLOCK_ROWS):
                n = used[k:k + BLOCK_ROWS].astype(np.float32)
                if n.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([salt], pa.int32()),
                         pa.array([n.tobytes()]), pa.array([((w[k:k + BLOCK_ROWS] - model.w[k:k + BLOCK_ROWS])
                                                            * n[:, None]).astype(np.float32).tobytes()])],
                        names=["block", "salt", "n", "step"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        n = sum(np.frombuffer(x, np.float32).astype(float) for x in table["n"].to_pylist())
        step = sum(np.frombuffer(x, np.float32).astype(float) for x in table["step"].to_pylist())
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "salt": pa.array([0], pa.int32()),
                         "n": [n.astype(np.float32).tobytes()], "step": [step.astype(np.float32).tobytes()]})

    schema = "block int, salt int, n binary, step binary"
    steps = rows.mapInArrow(run, schema)
    steps = steps.groupBy("block", "salt").applyInArrow(add, schema)
    steps = steps.groupBy("block").applyInArrow(add, schema)
    for r in steps.toLocalIterator():  # one row per block of the parameter table
        n, step = np.frombuffer(r.n, np.float32), np.frombuffer(r.step, np.float32).reshape(-1, CLASSES)
        model.w[r.block:r.block + len(n)] += step / np.maximum(1, n)[:, None]
    shared.unpersist()


def train_lm(train: DataFrame, hot_words: int = HOT_WORDS, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """(model, counts) from ``texts()`` rows; counts: (word, n) of every training word."""
    found = staged(_count_rows(train), "lm-partial", "kind")
    counts = staged(found.where("kind = 0").groupBy(F.col("key").alias("word")).agg(
        F.first("atom").alias("atom"), F.sum("n").alias("n")), "lm-counts")
    totals, types = np.zeros(ATOMS), np.zeros(ATOMS)
    for r in counts.groupBy("atom").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        totals[r.atom], types[r.atom] = r.n, r.v
    pairs = np.zeros(ATOMS * ATOMS, np.int64)
    got = found.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # at most ATOMS^2 rows
    pairs[got["key"].to_numpy()] = got["n"].to_numpy()
    # The smallest count that at most hot_words words reach, from the histogram of counts.
    upto, least = 0, 1
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("v")).orderBy(F.col("n").desc()).toLocalIterator():
        upto += r.v
        if upto > hot_words:
            least = r.n + 1
            break
    hot = counts.where(F.col("n") >= least).toArrow()
    model = Model(hot["word"].to_numpy().astype(np.int64), hot["n"].to_numpy().astype(np.int64),
                  hot["atom"].to_numpy().astype(np.int64), totals, types, pairs.reshape(ATOMS, ATOMS),
                  int(totals.sum()), int(types.sum()))
    for turn in range(rounds):
        _train_round(model, train.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(rounds)) == turn))
    return model, counts.select("word", "n")


def score_lm(rows: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of ``texts()`` rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        model, reader = shared.value, Reader()
        row = TaskContext.get().partitionId() << 33  # row numbers live for this table only

        def batch(kind: int, **cols) -> pa.RecordBatch:
            size = len(cols["row"])
            kinds = {"kind": np.full(size, kind, np.int32), "row": None, "doc_id": pa.array([None] * size, pa.int64()),
                     "word": np.zeros(size, np.int64), "n": None, "known": np.zeros(size, np.int64),
                     "count_log": np.zeros(size), "class_log": np.zeros(size)} | cols
            return pa.RecordBatch.from_arrays([pa.array(v) if not isinstance(v, pa.Array) else v for v in kinds.values()],
                                              names=list(kinds))

        for b in it:
            numbers, lens = reader.read(b.column(1))
            keys = reader.keys
            hot, log_count, cls, feature = reader.look_up(model)
            rows, want = history(feature[numbers], lens), cls[numbers]
            log_class = np.empty(len(want))
            for lo in range(0, len(want), BATCH):
                z = _logits(model, model.w, rows[lo:lo + BATCH])
                top = z.max(1)
                y = want[lo:lo + BATCH]
                log_class[lo:lo + BATCH] = (z[np.arange(len(y)), y] - top - np.log(np.exp(z - top[:, None]).sum(1))) / math.log(10)
            # In the model a word alone in its class needs no count.
            log_class -= np.where(model.alone[want], log_count[numbers], model.log_rest[want])
            at = np.cumsum(lens) - lens
            ids = row + np.arange(len(lens))
            row += len(lens)
            yield batch(0, row=ids, doc_id=b.column(0), n=lens, known=np.add.reduceat(hot[numbers].astype(np.int64), at),
                        count_log=np.add.reduceat(log_count[numbers], at), class_log=np.add.reduceat(log_class, at))
            cold = np.flatnonzero(~hot[numbers])
            if len(cold):
                doc = np.repeat(np.arange(len(lens)), lens)[cold]
                pair, n = np.unique(doc * len(keys) + numbers[cold], return_counts=True)
                yield batch(1, row=ids[pair // len(keys)], word=keys[pair % len(keys)], n=n)

    found = staged(rows.mapInArrow(run, "kind int, row bigint, doc_id bigint, word bigint, n bigint, known bigint, "
                                        "count_log double, class_log double"), "lm-scores", "kind")
    cold = found.where("kind = 1").select("row", "word", F.col("n").alias("times"))
    cold = cold.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("c_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("c_log"))
    whole = found.where("kind = 0").select("row", "doc_id", F.col("n").alias("n_tokens"), "known", "count_log", "class_log")
    words = F.col("count_log") + F.coalesce("c_log", F.lit(0.0))
    return whole.join(cold, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("c_known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (words - F.col("n_tokens") * F.lit(model.log_all)).alias("base_score"),
        (words + F.col("class_log")).alias("score"))


def is_held_out() -> Column:
    return F.coalesce(F.pmod(crc_of_id(F.col("doc_id")), F.lit(5)) == 1, F.lit(False))


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows that are not held out, score every row.

    Null and empty texts are one end token.  Rows with a null id are trained on; rows of
    equal id each get their score.  Other columns stay out.  An empty table gives no row;
    without training texts all probability is unseen mass.
    """
    prepare(docs.sparkSession)
    rows = texts(docs, id_col, text_col)
    model, counts = train_lm(rows.where(~is_held_out()))
    return score_lm(rows, model, counts).withColumn("held_out", is_held_out())


def op7_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all ``documents`` under unigrams and under the model."""
    got = lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
