"""Jaccard join on word shingles by T-occurrence search (DivideSkip), exact.

Two sets of sizes m and n are at least 4/5 similar when they share at least
T = ceil(4 (m + n) / 9) shingles.  With all shingles in one fixed order, rare before
frequent, a pair that reaches T shares one of its first (short-listed) shingles: DivideSkip
merges the short inverted lists for candidates and only probes the long ones.

1. Sets.  Every text is read once for its set size and a digest of its set; equal sets are
   one item from here on, so a group of exact copies, however large, is one row.  The same
   pass counts shingles twice over.  A bitmap of fixed size, built from bucket counts of all
   tasks, tells shingles that certainly occur in one set only: they come first in the order
   and, being in no list with another set, are never shipped.  A bounded table of shingles
   that are frequent within tasks is the tail of the order, so passages that many documents
   share stand in the long lists.
2. Short lists.  The head of each set, n - ceil(4n/5) + L shingles with L = 1 + n // 25, goes
   to inverted lists: packed (shingle, set) entries are shuffled by shingle bucket and
   merged there.  A pair that reaches T shares at least L of its head shingles (the smaller
   L of the two), so fewer meetings are chance and no candidate.
3. Candidates.  Of each list first only star pairs (one pivot against the others) are
   verified, over several rounds with other pivots, because linked sets need no second
   proof; then those of a list that are still in different components and whose parity
   signatures (an upper bound of the overlap) allow T, so no link between components is
   lost and sets that share a passage only are not paired.
4. Verification.  A candidate's remaining (long-list) shingles are probed by binary search
   in the pivot's sorted set, and the pair is a link if T is reached.

Only candidates' texts are read again.  A pivot with very many candidates is split over
tasks by the size of what it is compared with.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ID_BROADCAST_BYTES, prepare, space_words, staged, texts, trim_memory
from .components import merged

SHINGLE = 5
#: A shingle is frequent from this count in its tasks; the table holds the most frequent.
FREQUENT, FREQUENT_TABLE = 4, 1_000_000
#: Shingles sorted at once to find a task's frequent ones; counts below LOCAL are dropped
#: (they only place a shingle in the order).
COUNT_CHUNK, LOCAL = 2_000_000, 2
#: Slots of the bitmap (a power of two, one bit each), in ranges that are counted apart.
SLOT_BITS, RANGE_BITS = 28, 20
#: Entries per bucket of inverted lists, and the least number of buckets.
BUCKET_ENTRIES, LEAST_BUCKETS = 500_000, 256
#: A list longer than this (by the frequent table) is spread over several buckets.
SPLIT_LIST = 100_000
#: Shingles compared with one pivot in one task.
GROUP_SHINGLES = 20_000
#: Into how many parts the pivots are dealt where they are too many to broadcast.
HUB_PARTS = 64
#: Longs of a set's parity signature.
SIGNATURE = 8
STAR_ROUNDS = 3
#: How often sets that cannot reach any partner are dropped from the lists.
PRUNE_ROUNDS = 2

_C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
               0xA0761D6478BD642F], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit shingles: 5-word windows, or the whole of a shorter text."""
    from xxhash import xxh3_64_intdigest

    words = space_words(text)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if not len(h):
        return h
    n = len(h) - SHINGLE + 1
    if n > 0:
        s = sum(h[k:k + n] * _C[k] for k in range(SHINGLE))
    else:
        s = np.array([(h * _C[:len(h)]).sum(dtype=np.uint64) + np.uint64(len(h))], np.uint64)
    return np.unique(_mixed(s))


def digest(shingles: np.ndarray) -> int | None:
    """Signed 64-bit digest of a set; none for an empty one."""
    from xxhash import xxh3_64_intdigest

    if not len(shingles):
        return None
    d = xxh3_64_intdigest(shingles.tobytes(), seed=len(shingles))
    return d - (1 << 64) if d >= 1 << 63 else d


def signature(shingles: np.ndarray) -> list[int]:
    """Parity of how many shingles fall on each of 64 SIGNATURE bits.

    A shingle of one set only changes one bit, a shared one none: two sets differ in at
    least as many shingles as their signatures differ in bits."""
    bits = np.bincount((_mixed(shingles) >> np.uint64(32)) % np.uint64(64 * SIGNATURE), minlength=64 * SIGNATURE)
    return np.packbits((bits & 1).astype(np.uint8)).view("<i8").tolist()


def least_meetings(n: int) -> int:
    """How many head shingles two sets of this size or more have in common."""
    return 1 + n // 25


def head_length(n: int) -> int:
    return min(n, n - -(-4 * n // 5) + least_meetings(n))


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _read_sets(rows: DataFrame) -> DataFrame:
    """kind 0: (doc_id, text_key, n, digest, signature) of each row; kind 1: (digest: shingle, n: count);
    kind 2: (n: range, slots: sorted slots of the range, one for each occurrence)."""
    names = ["kind", "doc_id", "text_key", "n", "digest", "slots", "signature"]

    def out(kind: int, n, ids=None, keys=None, d=None, slots=None, signs=None) -> pa.RecordBatch:
        none = [None] * len(n)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), kind, np.int32)), pa.array(ids if ids is not None else none, pa.int64()),
             pa.array(keys if keys is not None else none, pa.int64()),
             pa.array(n, pa.int64()), pa.array(d if d is not None else none, pa.int64()),
             pa.array(slots if slots is not None else none, pa.binary()),
             pa.array(signs if signs is not None else none, pa.list_(pa.int64()))], names=names)

    def counted(parts: list[np.ndarray]) -> Iterable[pa.RecordBatch]:
        flat = np.sort(np.concatenate(parts))
        slots = _slots(flat)
        which = slots >> RANGE_BITS
        first = np.flatnonzero(np.diff(which, prepend=-1))
        inside = (slots & ((1 << RANGE_BITS) - 1)).astype("<u4")
        # As gaps the sorted slots compress well.
        gaps = [np.diff(p, prepend=np.uint32(0)).astype("<u4").tobytes() for p in np.split(inside, first[1:])]
        yield out(2, which[first], slots=gaps)
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        n = np.diff(first, append=len(flat))
        yield out(1, n[n >= LOCAL], d=flat[first[n >= LOCAL]].view(np.int64))

    def run(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        seen: set[int] = set()
        held, size = [], 0
        for b in it:
            sets = [shingle_set(t) for t in b.column(1).to_pylist()]
            digests = [digest(s) for s in sets]
            yield out(0, [len(s) for s in sets], b.column(0).to_pylist(), b.column(2).to_pylist(), digests,
                      signs=[signature(s) if len(s) else None for s in sets])
            for d, s in zip(digests, sets, strict=True):
                if d is not None and d not in seen:  # a copy says nothing new
                    seen.add(d)
                    held.append(s)
                    size += len(s)
            if size > COUNT_CHUNK:
                yield from counted(held)
                held, size = [], 0
        if held:
            yield from counted(held)
        del seen, held
        trim_memory()

    return rows.mapInArrow(run, "kind int, doc_id bigint, text_key bigint, n bigint, digest bigint, slots binary, "
                           "signature array<bigint>")


def _shared_slots(read: DataFrame) -> np.ndarray:
    """Bitmap (packed) of the slots that more than one occurrence fell into."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        hits = np.zeros(1 << RANGE_BITS, np.uint8)  # 0, 1, or 2 for more
        for raw in table["slots"]:
            at = np.cumsum(np.frombuffer(raw.as_py(), "<u4"), dtype=np.int64)
            twice = at[1:][at[1:] == at[:-1]]
            hits[at] = np.minimum(hits[at] + 1, 2)
            hits[twice] = 2
        return pa.table({"range": pa.array([key[0].as_py()], pa.int64()), "bits": [np.packbits(hits > 1).tobytes()]})

    whole = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
    size = 1 << (RANGE_BITS - 3)
    ranges = read.where("kind = 2").groupBy("n").applyInArrow(merge, "range bigint, bits binary")
    for r in ranges.toLocalIterator():  # a fixed number of rows of a fixed size
        whole[r.range * size:(r.range + 1) * size] = np.frombuffer(r.bits, np.uint8)
    return whole


class Order:
    """The fixed order of shingles: those of one set only, then by value, then the frequent
    ones by count."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray, shared: np.ndarray):
        by = np.argsort(shingles)
        self.shingles, self.counts, self.shared = shingles[by], counts[by], shared

    def is_shared(self, s: np.ndarray) -> np.ndarray:
        """False only for shingles that no second set has."""
        slot = _slots(s)
        return (self.shared[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 > 0

    def frequency(self, s: np.ndarray) -> np.ndarray:
        """Count of frequent shingles, 0 for the others."""
        if not len(self.shingles):
            return np.zeros(len(s), np.int64)
        k = np.minimum(np.searchsorted(self.shingles, s), len(self.shingles) - 1)
        return np.where(self.shingles[k] == s, self.counts[k], 0)

    def head(self, s: np.ndarray) -> np.ndarray:
        """The first shingles of a sorted set in this order, without those of one set only."""
        some = s[self.is_shared(s)]
        left = head_length(len(s)) - (len(s) - len(some))
        if left <= 0:
            return some[:0]
        f = self.frequency(some)
        return some[np.lexsort((some, f))[:left]]


_ENTRY = np.dtype([("shingle", "<u8"), ("item", "<i8")])


def _short_lists(rows: DataFrame, order: Order, buckets: int) -> DataFrame:
    """(shingle, item): entries of the inverted lists of several sets."""
    shared = rows.sparkSession.sparkContext.broadcast(order)

    def turns(entry: np.ndarray) -> np.ndarray:
        """Over how many buckets a very long list is spread."""
        return shared.value.frequency(entry["shingle"]) // SPLIT_LIST + 1

    def pack(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        seen, held, size = set(), [], 0

        def flush() -> pa.RecordBatch:
            entry = np.concatenate(held)
            salt = _mixed(entry["item"].view(np.uint64)) % turns(entry).astype(np.uint64)
            bucket = (_mixed(entry["shingle"] + salt) % np.uint64(buckets)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            first = np.flatnonzero(np.diff(bucket[by], prepend=-1))
            parts = np.split(entry[by], first[1:])
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[by][first]), pa.array([p.tobytes() for p in parts], pa.binary())],
                names=["bucket", "entries"])

        for b in it:
            for t in b.column(1).to_pylist():
                s = shingle_set(t)
                d = digest(s)
                if d is None or d in seen:
                    continue
                seen.add(d)
                head = shared.value.head(s)
                e = np.empty(len(head), _ENTRY)
                e["shingle"], e["item"] = head, d
                held.append(e)
                size += len(e)
            if size > BUCKET_ENTRIES:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        """Merge the runs of a bucket into lists; keep lists of several sets."""
        e = np.concatenate([np.frombuffer(x, _ENTRY) for x in table["entries"].to_pylist()])
        e = e[np.lexsort((e["item"], e["shingle"]))]
        e = e[np.concatenate([[True], e[1:] != e[:-1]])]
        first = np.flatnonzero(np.concatenate([[True], e["shingle"][1:] != e["shingle"][:-1]]))
        n = np.diff(first, append=len(e))
        e = e[(np.repeat(n, n) > 1) | (turns(e) > 1)]
        return pa.table({"shingle": e["shingle"].view(np.int64), "item": e["item"]})

    packed = rows.mapInArrow(pack, "bucket int, entries binary")
    return packed.groupBy("bucket").applyInArrow(merge, "shingle bigint, item bigint")


def _verified(docs: DataFrame, items: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links (a, b) among candidate ``pairs`` (a: pivot, b, a_n, b_n), their texts read again.

    ``docs``: (doc_id, text, text_key); ``items``: (item, doc_id, text_key).  The rows of
    a pivot are spread over salts by the number of shingles to be compared."""
    n_b = items.select(F.col("item").alias("b"), F.col("doc_id").alias("b_doc"), F.col("text_key").alias("b_key"))
    of_a = items.select(F.col("item").alias("a"), "doc_id", "text_key")
    # Sizes first: 5 min >= 4 max, or the pair cannot reach T.
    sized = staged(pairs.where("5 * least(a_n, b_n) >= 4 * greatest(a_n, b_n)").join(n_b, "b"), "candidates")
    hubs = staged(sized.groupBy("a").agg(F.ceil(F.sum("b_n") / F.lit(float(GROUP_SHINGLES))).cast("int").alias(
        "salts")).join(of_a, "a"), "hubs")
    # Candidates are not shuffled by their pivot, which may be hot: only pivots of several
    # salts are looked up, broadcast where their measured number allows, else dealt in parts.
    heavy = hubs.where("salts > 1").select("a", "salts")
    if heavy.count() * 64 <= ID_BROADCAST_BYTES:
        dealt = sized.join(F.broadcast(heavy), "a", "left")
    else:
        parts = heavy.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(HUB_PARTS - 1))))
        dealt = sized.withColumn("part", F.pmod(F.xxhash64("b", F.lit(1)), F.lit(HUB_PARTS)).cast("int")).join(
            parts, ["a", "part"], "left")
    salt = F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1))).cast("int")
    wanted = (dealt.select(F.col("b_doc").alias("doc_id"), F.col("b_key").alias("text_key"), "a", salt.alias("salt"),
                           F.col("b").alias("item"))
              .unionByName(hubs.select("doc_id", "text_key", "a", F.explode(F.sequence(
                  F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("a").alias("item"))))
    wanted = staged(wanted, "wanted")
    few = wanted.count() * 64 <= ID_BROADCAST_BYTES
    at = ["doc_id", "text_key"]
    rows = docs.join(F.broadcast(wanted) if few else wanted, at).select("a", "salt", "item", "text")
    nameless = wanted.where("doc_id IS NULL").drop("doc_id")
    if nameless.limit(1).count():
        # Sets without any id: one row of each text, however often it stands there.
        keys = nameless.select("text_key").distinct()
        once = docs.where("doc_id IS NULL").drop("doc_id").join(
            F.broadcast(keys) if few else keys, "text_key", "left_semi").dropDuplicates(["text_key"])
        rows = rows.unionByName(once.join(F.broadcast(nameless) if few else nameless, "text_key").select(
            "a", "salt", "item", "text"))

    def sets(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in it:
            got = [shingle_set(t) for t in b.column(3).to_pylist()]
            # Of rows that repeat an id, only the one with the wanted set counts.
            ok = pa.array(np.flatnonzero([digest(s) == i for s, i in zip(got, b.column(2).to_pylist(), strict=True)]))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k).take(ok) for k in range(3)),
                 pa.array([got[k].tobytes() for k in ok.to_pylist()], pa.binary())],
                names=["a", "salt", "item", "shingles"])

    def probe(key: tuple, table: pa.Table) -> pa.Table:
        """Probe every candidate's shingles in the pivot's set by binary search."""
        a, found, own = key[0].as_py(), [], None
        items = table["item"].to_pylist()
        if a in items:
            own = np.frombuffer(table["shingles"][items.index(a)].as_py(), np.uint64)
            done = {a}
            for item, raw in zip(items, table["shingles"], strict=True):
                if item not in done:
                    done.add(item)
                    s = np.frombuffer(raw.as_py(), np.uint64)
                    at = np.minimum(np.searchsorted(own, s), len(own) - 1)
                    if 9 * int((own[at] == s).sum()) >= 4 * (len(own) + len(s)):
                        found.append(item)
        return pa.table({"a": pa.array([a] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    linked = (rows.mapInArrow(sets, "a bigint, salt int, item bigint, shingles binary")
              .groupBy("a", "salt").applyInArrow(probe, "a bigint, b bigint"))
    return staged(linked, "links")


def _reachable(lists: DataFrame) -> DataFrame:
    """Lists without the sets that stand in too few of them to reach any partner's L, and
    without lists that this leaves with one set.  Adds ``weight``: lists a set stands in.

    A partner has at least 4/5 of a set's size, so it asks for 1 + floor((4n/5) / 25)."""
    stands = lists.groupBy("item").agg(F.count(F.lit(1)).alias("weight"), F.first("n").alias("size")).where(
        "weight >= 1 + floor(4 * size / 125)").select("item", "weight")
    kept = staged(lists.drop("weight").join(stands, "item"), "short-lists")
    several = kept.groupBy("shingle").agg(F.min("item").alias("lo"), F.max("item").alias("hi")).where("lo < hi")
    return staged(kept.join(several.select("shingle"), "shingle", "left_semi"), "short-lists")


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key (hash of the text), n, digest, component_id, and
    ``first``: (anonymous, doc_id, text_key) of the smallest row of its component, rows
    without an id last.  Texts without words have no digest, no component and no first."""
    spark = docs.sparkSession
    prepare(spark)
    rows = texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    read = staged(_read_sets(rows), "shingle-sets", "kind")
    sets = read.where("kind = 0")
    info = sets.select("doc_id", "text_key", "n", "digest")
    heads = info.agg(F.sum(F.col("n") / 4 + 1)).first()[0] or 0
    often = staged(read.where("kind = 1").groupBy("digest").agg(F.sum("n").alias("n"))
                   .where(F.col("n") >= FREQUENT), "frequent-shingles")
    # The smallest count that keeps the table bounded, from the histogram of counts.
    upto, least = 0, FREQUENT
    for r in often.groupBy("n").agg(F.count(F.lit(1)).alias("v")).orderBy(F.col("n").desc()).toLocalIterator():
        upto += r.v
        if upto > FREQUENT_TABLE:
            least = r.n + 1
            break
    often = often.where(F.col("n") >= least).toArrow()
    order = Order(often["digest"].to_numpy().astype(np.int64).view(np.uint64), often["n"].to_numpy().astype(np.int64),
                  _shared_slots(read))
    items = staged(sets.where("digest IS NOT NULL").groupBy(F.col("digest").alias("item")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "text_key")).alias("first"),
        F.first("n").alias("n"), F.first("signature").alias("signature")).select(
            "item", "first", "first.doc_id", "first.text_key", "n", "signature"), "items")
    buckets = max(LEAST_BUCKETS, int(heads // BUCKET_ENTRIES) + 1)
    lists = staged(_short_lists(rows, order, buckets).join(
        items.select("item", "n"), "item"), "short-lists")
    del order  # its tables are not needed on the driver any more
    for _ in range(PRUNE_ROUNDS):
        lists = _reachable(lists)

    labels = None
    for turn in range(STAR_ROUNDS + 1):
        if labels is None:
            placed = lists.withColumn("root", F.col("item"))
        else:
            at = labels.select(F.col("node").alias("item"), F.col("root").alias("r"))
            placed = lists.join(at, "item", "left").withColumn("root", F.coalesce("r", "item")).drop("r")
            placed = staged(placed, "placed-lists")
        # Lists that still join different components.
        open_lists = (placed.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                      .where("lo < hi").select("shingle"))
        placed = placed.join(open_lists, "shingle", "left_semi")
        if turn < STAR_ROUNDS:
            # One pivot per list and size class (sizes within a factor of 5/4).
            band = F.floor(F.log("n") / F.lit(float(np.log(1.25))))
            placed = placed.withColumn("band", band)
            # First the set that stands in most lists: of near copies the one changed least,
            # which is nearest to all.  Then the same among sets not yet linked, then any.
            first = (F.lit(0) if turn > 1 else -F.col("weight") if not turn else
                     F.when(F.col("root") == F.col("item"), -F.col("weight")).otherwise(F.lit(0)))
            pivot = placed.groupBy("shingle", "band").agg(F.min(F.struct(
                first.cast("long").alias("first"), F.xxhash64("item", F.lit(turn)).alias("h"), "item", "root", "n")
            ).alias("p")).select(
                "shingle", "band", F.col("p.item").alias("a"), F.col("p.root").alias("p_root"), F.col("p.n").alias("a_n"))
            # A set also meets the pivot of the band below, whose sizes may be near its own.
            meets = pivot.unionByName(pivot.withColumn("band", F.col("band") + 1))
            met = (placed.join(meets, ["shingle", "band"]).where("root <> p_root")
                   .select("a", "a_n", F.col("item").alias("b"), F.col("n").alias("b_n")))
            share = 0.5  # a list may have had another pivot; what this misses comes last
        else:
            # Sets that reach T differ in at most a ninth of both sizes, and so do their
            # signatures: what shares a passage only is not paired.
            placed = placed.join(items.select("item", "signature"), "item")
            left, right = [placed.select("shingle", F.col("item").alias(x), F.col("root").alias(f"{x}_root"),
                                         F.col("n").alias(f"{x}_n"), F.col("signature").alias(f"{x}_s"))
                           for x in "ab"]
            differ = " + ".join(f"bit_count(a_s[{k}] ^ b_s[{k}])" for k in range(SIGNATURE))
            met = left.join(right, "shingle").where(
                "a_root <> b_root AND (a_n < b_n OR (a_n = b_n AND a < b)) AND 5 * a_n >= 4 * b_n "
                f"AND 9 * ({differ}) <= a_n + b_n").select("a", "b", "a_n", "b_n")
            share = 1.0
        needed = 1 + F.floor(F.least("a_n", "b_n") / 25)
        pairs = (met.groupBy("a", "b", "a_n", "b_n").agg(F.count(F.lit(1)).alias("meetings"))
                 .where(F.col("meetings") >= needed * F.lit(share)).drop("meetings"))
        links = _verified(rows, items, pairs)
        if links.limit(1).count():
            labels = merged(labels, links)

    if labels is None:
        homes = items.select(F.col("item").alias("digest"), "first")
    else:
        at = labels.select(F.col("node").alias("item"), "root")
        grouped = staged(items.join(at, "item", "left").select(
            "item", "first", F.coalesce("root", "item").alias("root")), "item-roots")
        lowest = grouped.groupBy("root").agg(F.min("first").alias("first"))
        homes = grouped.drop("first").join(lowest, "root").select(F.col("item").alias("digest"), "first")
    return info.join(homes, "digest", "left").select(
        "doc_id", "text_key", "n", "digest", F.col("first.doc_id").alias("component_id"), "first")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``.

    Links: 100 x intersection >= 80 x union of the shingle sets.  Texts without words have
    no shingle and stand alone.  Rows of equal id and different text are nodes of their
    own; rows with a null id link and carry others' links, but name no component (alone,
    their component is null).  Other columns stay out.  An empty table gives no row.
    """
    return _grouped(docs, id_col, text_col).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, keeps) per row of ``docs`` that has words: whether it is the row of
    its component to keep, that of the smallest (doc_id, text_key), null ids last.  Equal
    rows (same id and text) have the same answer."""
    found = _grouped(docs, id_col, text_col).where("digest IS NOT NULL")
    return found.select("doc_id", "text_key", (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
                                               & (F.col("text_key") == F.col("first.text_key"))).alias("keeps"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` under Jaccard similarity of at least 0.8."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
