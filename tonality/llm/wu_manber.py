"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``window`` consecutive words of the benchmark items (an item
with fewer words is one shorter pattern).  Words become integers through the benchmark's
own vocabulary (0: not in it), and the search runs on those:

* shift table: for each block of two words, how far the window may move without missing
  a pattern.  A block that ends no prefix of any pattern moves it by the whole window;
* suffix buckets: where the shift is zero, the patterns that end in that block;
* direct comparison of all words of those patterns with the text.

The cursor loop is vectorised: documents are cut into segments of ``SEGMENT`` start
positions (reading ``window - 1`` words on, so no occurrence is lost) and all segments
of an Arrow batch move one step at a time.  Every document is scanned where it lies: no
shuffle, and a hot source, a hot passage or a long text only makes more segments.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alnum_words, prepare, texts, trim_memory

WINDOW = 10
SEGMENT = 256
HASH_BITS = 18
#: Benchmark text per block: one block is collected, compiled and broadcast at a time.
BLOCK_BYTES = 8 << 20

SCHEMA = ("doc_id bigint, text_key bigint, n_words bigint, span_starts array<bigint>, "
          "span_ends array<bigint>, items array<bigint>")


class Patterns:
    """Compiled windows of a block of benchmark items, by length."""

    def __init__(self, items: Iterable[tuple[int, bytes | None]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        owners: dict[int, dict[tuple[int, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in alnum_words(text)]
            m = min(window, len(ids))
            for k in range(len(ids) - m + 1 if m else 0):
                owners[m][tuple(ids[k:k + m])].add(item)
        self.by_length = [_Group(m, found) for m, found in sorted(owners.items())]

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, len(words))


def _block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Table slot of a block of two words."""
    mixed = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) * np.uint64(
        0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(64 - HASH_BITS)).astype(np.int64)


class _Group:
    """Patterns of one length: shift table, suffix buckets, owners."""

    def __init__(self, m: int, found: dict[tuple[int, ...], set[int]]):
        self.m = m
        self.words = np.array(list(found), np.int64).reshape(len(found), m)
        owner_lists = [sorted(s) for s in found.values()]
        self.owner_len = np.array([len(s) for s in owner_lists], np.int64)
        self.owner_at = np.cumsum(self.owner_len) - self.owner_len
        self.owners = np.array([i for s in owner_lists for i in s], np.int64)
        self.shift = np.full(1 << HASH_BITS, max(1, m - 1), np.int64)
        for j in range(1, m):
            np.minimum.at(self.shift, _block(self.words[:, j - 1], self.words[:, j]), m - 1 - j)
        last = _block(self.words[:, max(0, m - 2)] if m > 1 else np.zeros(len(found), np.int64),
                      self.words[:, m - 1])
        if m == 1:
            self.shift[last] = 0
        order = np.argsort(last, kind="stable")
        self.bucket = order
        self.bucket_at = np.searchsorted(last[order], np.arange((1 << HASH_BITS) + 1))

    def occurrences(self, ids: np.ndarray, starts: np.ndarray,
                    ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end position, pattern) of every occurrence inside the documents given by
        their word ranges in ``ids``."""
        m = self.m
        seg_per_doc = np.maximum(0, -(-(ends - starts - m + 1) // SEGMENT))
        doc = np.repeat(np.arange(len(starts)), seg_per_doc)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(seg_per_doc) - seg_per_doc, seg_per_doc)
        first = starts[doc] + nth * SEGMENT
        pos = first + m - 1
        stop = np.minimum(first + SEGMENT + m - 1, ends[doc])
        zero_at, zero_slot = [], []
        while len(pos):
            slot = _block(ids[pos - 1] if m > 1 else np.zeros(len(pos), np.int64), ids[pos])
            move = self.shift[slot]
            hit = move == 0
            if hit.any():
                zero_at.append(pos[hit])
                zero_slot.append(slot[hit])
            pos = pos + np.maximum(move, 1)
            live = pos < stop
            if not live.all():
                pos, stop = pos[live], stop[live]
        if not zero_at:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at, slot = np.concatenate(zero_at), np.concatenate(zero_slot)
        n = self.bucket_at[slot + 1] - self.bucket_at[slot]
        base = np.repeat(self.bucket_at[slot] - (np.cumsum(n) - n), n)
        pattern = self.bucket[base + np.arange(n.sum())]
        at = np.repeat(at, n)
        for j in range(m):  # compare word by word; few candidates live past the first
            same = ids[at - (m - 1) + j] == self.words[pattern, j]
            at, pattern = at[same], pattern[same]
        return at, pattern


def scan_batch(patterns: Patterns, docs: list[list[bytes]]) -> tuple[list, list, list]:
    """Per document: merged hit spans (starts, ends: word positions, end exclusive) and
    the sorted ids of the items with an occurring window."""
    lens = np.array([len(w) for w in docs], np.int64)
    ends = np.cumsum(lens)
    starts = ends - lens
    ids = (np.concatenate([patterns.ids(w) for w in docs]) if len(docs) else
           np.empty(0, np.int64))
    edge = np.zeros(len(ids) + 1, np.int64)
    hit_doc, hit_item = [], []
    for group in patterns.by_length:
        at, pattern = group.occurrences(ids, starts, ends)
        if not len(at):
            continue
        np.add.at(edge, at - (group.m - 1), 1)
        np.add.at(edge, at + 1, -1)
        n = group.owner_len[pattern]
        base = np.repeat(group.owner_at[pattern] - (np.cumsum(n) - n), n)
        hit_item.append(group.owners[base + np.arange(n.sum())])
        hit_doc.append(np.repeat(np.searchsorted(ends, at, side="right"), n))
    span_starts: list = [[] for _ in docs]
    span_ends: list = [[] for _ in docs]
    items: list = [[] for _ in docs]
    if hit_doc:
        covered = np.cumsum(edge[:-1]) > 0
        step = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
        ups, downs = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        for a, b in zip(ups.tolist(), downs.tolist(), strict=True):
            d = int(np.searchsorted(ends, a, side="right"))
            while a < b:  # a run that goes on into the next document is one span in each
                cut = min(b, int(ends[d]))
                if cut > a:
                    span_starts[d].append(a - int(starts[d]))
                    span_ends[d].append(cut - int(starts[d]))
                a, d = cut, d + 1
        pairs = np.unique(np.stack([np.concatenate(hit_doc), np.concatenate(hit_item)], 1), axis=0)
        for d, i in pairs.tolist():
            items[d].append(i)
    return span_starts, span_ends, items


def _scan(docs: DataFrame, patterns: Patterns) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    def run(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        trim_memory()
        for b in it:
            words = [alnum_words(t) for t in b.column(1).to_pylist()]
            found = scan_batch(shared.value, words)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([len(w) for w in words], pa.int64()),
                 *(pa.array(x, longs) for x in found)],
                names=["doc_id", "text_key", "n_words", "span_starts", "span_ends", "items"])
        trim_memory()

    return docs.mapInArrow(run, SCHEMA)


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text",
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_words, merged hit spans and the items.

    The benchmark is taken in blocks of about ``block_bytes`` text (its size is measured),
    each compiled on the driver and broadcast; with one block, the usual case, a row's
    result is final where it is scanned.  With more, the spans of each block are merged
    per (document, text).

    Null or empty texts have no words and no hits; items without words have no window;
    rows with a null item id are left out.  Repeated rows each get their result.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = texts(docs, id_col, text_col)
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    bench = benchmark.select(
        benchmark[item_col].cast("long").alias("item_id"),
        benchmark[item_text_col].cast("string").cast("binary").alias("text"),
    ).where("item_id IS NOT NULL")
    size = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))

    def compiled(k: int) -> Patterns:
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        return Patterns(((r.item_id, bytes(r.text) if r.text is not None else None)
                         for r in part.toLocalIterator()), window)

    if blocks == 1:
        return _scan(rows, compiled(0))
    parts = None
    for k in range(blocks):
        one = _scan(rows, compiled(k)).withColumn("block", F.lit(k))
        parts = one if parts is None else parts.unionByName(one)
    # Equal rows have equal results, so one per block is enough.
    once = parts.groupBy("doc_id", "text_key", "block").agg(
        F.first("n_words").alias("n_words"), F.first("span_starts").alias("s"),
        F.first("span_ends").alias("e"), F.first("items").alias("items"))
    merged = once.groupBy("doc_id", "text_key").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("s", "e")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    union = F.aggregate(
        "spans", F.array().cast("array<struct<s:bigint,e:bigint>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= x["s"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
                F.element_at(acc, -1)["s"].alias("s"),
                F.greatest(F.element_at(acc, -1)["e"], x["e"]).alias("e")))),
        ).otherwise(F.concat(acc, F.array(x))))
    merged = merged.withColumn("spans", union).select(
        F.col("doc_id").alias("k1"), F.col("text_key").alias("k2"), "n_words",
        F.col("spans.s").alias("span_starts"), F.col("spans.e").alias("span_ends"), "items")
    keys = rows.select("doc_id", "text_key")
    return keys.join(merged, keys.doc_id.eqNullSafe(merged.k1) & (keys.text_key == merged.k2)
                     ).drop("k1", "k2")


def report(found: DataFrame) -> DataFrame:
    """Digest of ``find_benchmark``: words, hit words, items, verdict."""
    n_hit = F.aggregate(F.arrays_zip("span_starts", "span_ends"), F.lit(0).cast("long"),
                        lambda acc, x: acc + x["span_ends"] - x["span_starts"])
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def op5_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of 10-word windows of ``benchmark`` in all of ``documents``."""
    return report(find_benchmark(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                                 spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
