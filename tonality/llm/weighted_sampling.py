"""Document fingerprints by consistent weighted sampling (DataFrame functions only).

A text is a bag of words (lower-cased, parted by white space), the weight of a word being
how often it occurs.  For slot k and word w two Gamma(2, 1) numbers r, c and a uniform
number b are hashed from (w, k); with weight x:

    t = floor(ln x / r + b),   ln y = r (t - b),   ln a = ln c - ln y - r

The slot takes the (word, t) of least a.  Two texts agree in a slot with a chance equal to
the generalised Jaccard similarity, sum of min weights / sum of max weights.

The texts are shuffled once, into ranges of (doc_id, text hash): a window inside a range
finds each document's successor, words are counted and slots minimised on that same
partitioning.  A copy of each range's first row, added to the range before it, gives the
last row its successor.  A hot source or thousands of equal texts are spread by their ids.

Defined cases: a null text is an empty one; a text without words has the fingerprint '',
like (1.0) to others without words and unlike (0.0) to all with some; null ids come first
and equal ids are ordered by (text hash, text), so repeated rows are each other's
successors; the successor of a single document is itself.  Other columns stay out.  Rows of
equal id and text cannot be cut apart (one range, spilling).  An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged
from .splitters import range_of

SLOTS = 40
GROUP = 8
#: Rows a range aims at, ranges a task gets (so that tasks even out), the most ranges, and
#: sampled rows per range (bounds the driver).
RANGE_ROWS = 250
RANGES_PER_TASK = 8
MAX_RANGES = 65_536
SAMPLE_PER_RANGE = 16

NO_ID = -(1 << 63)
LOW32 = 0xFFFFFFFF


def words(text: Column) -> Column:
    """Words of the text as 64-bit hashes, in order, repeats included."""
    parts = F.split(F.lower(text), "[ \\t\\n\\x0B\\f\\r]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def sample(word: Column, log_weight: Column, slot: int) -> Column:
    """One 64-bit number: ln a in fixed point above 32 bits that name (word, t).

    Its least value over a text's words is the slot's sample; ties of a fall to the name.
    The five uniform numbers are the bits of two hashes, 25 each and 28 for b."""
    def uniform(bits: Column, n: int) -> Column:
        return (bits + F.lit(0.5)) * F.lit(2.0 ** -n)

    def field(h: Column, at: int, n: int) -> Column:
        return F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << n) - 1))

    def gamma2(h: Column) -> Column:
        return -F.log(uniform(field(h, 0, 25), 25) * uniform(field(h, 25, 25), 25))

    one = F.when(word.isNotNull(), F.xxhash64(word, F.lit(slot)))
    two = F.xxhash64(one)
    r, c = gamma2(one), gamma2(two)
    b = uniform(F.shiftleft(field(one, 50, 14), 14).bitwiseOR(field(two, 50, 14)), 28)
    t = F.floor(log_weight / r + b)
    log_a = F.log(c) - r * (t - b + F.lit(1.0))
    # ln a lies in (-100, 4): r and c are under 36, weights under 2^31.
    high = ((log_a + F.lit(100.0)) * F.lit(float(1 << 24))).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(F.xxhash64(one, t).bitwiseAND(F.lit(LOW32)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal slots; texts without words (null signatures) are alike."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, F.lit(1)).otherwise(F.lit(0))),
                       F.lit(0), lambda s, x: s + x)
    return (F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0))
            .otherwise(same.cast("double") / F.size(a)))


def as_text(signature: Column) -> Column:
    """Eight hexadecimal digits a slot; '' for texts without words."""
    digits = F.transform(signature, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def _ranges(keys: DataFrame) -> tuple[list[tuple[int, int]], int]:
    """Boundaries of (d, h) from a hashed sample, and the number of tasks for the ranges."""
    n = keys.count()
    wanted = max(1, min(MAX_RANGES, math.ceil(n / RANGE_ROWS)))
    if wanted == 1:
        return [], 1
    chance = min(1.0, wanted * SAMPLE_PER_RANGE / n)
    drawn = keys.where(F.pmod(F.xxhash64("d", "h", F.lit(17)), F.lit(1 << 30)) < F.lit(int(chance * (1 << 30))))
    rows = sorted((r.d, r.h) for r in drawn.collect())  # about wanted x SAMPLE_PER_RANGE
    cuts = sorted({rows[len(rows) * k // wanted] for k in range(1, wanted)}) if rows else []
    return cuts, min(wanted, math.ceil(n / (RANGE_ROWS * RANGES_PER_TASK)))


def with_successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bin, nth, extra, doc_id, text, successor): every row with the text of the next one.

    Rows with ``extra`` are copies of the next range's first row, at each range's end."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("d"),
                       F.xxhash64(text).alias("h"))
    cuts, tasks = _ranges(rows.select("d", "h"))
    rows = rows.withColumn("bin", range_of(F.col("d"), F.col("h"), cuts).cast("int"))
    # One row a range: at most MAX_RANGES.  Null ids sort before the smallest id.
    key = F.struct(F.col("doc_id").isNotNull(), "d", "h")
    firsts = staged(rows.groupBy("bin").agg(F.min(key).alias("k")).select("bin", "k"), "first-keys")
    nth = Window.orderBy("bin")
    after = firsts.select(
        F.coalesce(F.lag("bin").over(nth), F.max("bin").over(nth.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("to_bin"),
        F.col("bin").alias("f_bin"), F.col("k.d").alias("f_d"), F.col("k.h").alias("f_h"))
    extra = (rows.join(F.broadcast(after), (rows.bin == F.col("f_bin")) & (rows.d == F.col("f_d"))
                       & (rows.h == F.col("f_h")))
             .groupBy("to_bin", "f_bin").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "text")).alias("k"))
             .select(F.lit(None).cast("long").alias("doc_id"), F.col("k.text").alias("text"),
                     F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("h"),
                     F.col("to_bin").alias("bin"), F.lit(True).alias("extra")))
    both = rows.withColumn("extra", F.lit(False)).unionByName(staged(extra, "first-rows"))
    both = both.repartition(tasks, "bin")
    order = Window.partitionBy("bin").orderBy("extra", F.col("doc_id").isNotNull(), "d", "h", "text")
    return both.select("bin", F.row_number().over(order).cast("long").alias("nth"), "extra", "doc_id", "text",
                       F.lead("text").over(order).alias("successor"))


def signed(rows: DataFrame, facts: Sequence[str], text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(bin, entry, facts, signature array<bigint>) of each row (bin, entry, text, facts).

    Entries are unique, facts are bigints.  A partitioning by ``bin`` is kept: nothing here
    adds an exchange.  Facts travel as entries before the words, so that counting needs no
    wider rows.  Slots are drawn ``GROUP`` at a time, a row each, so that the generated
    aggregation stays small enough to be compiled; a group's hash makes its slots its own."""
    if slots % GROUP:
        raise ValueError(f"slots must be a multiple of {GROUP}")
    n = len(facts)
    values = F.concat(F.array(*[F.col(f) for f in facts]), words(F.col(text_col)))
    spread = rows.select("bin", "entry", F.posexplode(values).alias("pos", "word"))
    counted = (spread.select("bin", "entry", F.least("pos", F.lit(n)).alias("part"), "word")
               .groupBy("bin", "entry", "part", "word").agg(F.count(F.lit(1)).alias("n")))
    is_word = F.col("part") == n
    every = F.array(*[F.lit(g) for g in range(slots // GROUP)])
    dealt = counted.select("bin", "entry", "part", "word", F.log(F.col("n").cast("double")).alias("log_n"),
                           F.explode(F.when(is_word, every).otherwise(F.array(F.lit(0)))).alias("g"))
    dealt = dealt.withColumn("drawn", F.when(is_word, F.xxhash64("word", "g")))
    least = dealt.groupBy("bin", "entry", "g").agg(
        *[F.min(sample(F.col("drawn"), F.col("log_n"), k)).alias(f"s{k}") for k in range(GROUP)],
        *[F.max(F.when(F.col("part") == i, F.col("word"))).alias(f) for i, f in enumerate(facts)])
    names = F.array(*[F.col(f"s{k}").bitwiseAND(F.lit(LOW32)) for k in range(GROUP)])
    parts = F.sort_array(F.collect_list(F.struct("g", F.when(F.col("s0").isNotNull(), names).alias("names"))))
    whole = least.groupBy("bin", "entry").agg(parts.alias("p"), *[F.max(f).alias(f) for f in facts])
    signature = F.flatten(F.transform("p", lambda x: x["names"]))
    return whole.select("bin", "entry", *facts, signature.alias("signature"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(doc_id, signature, fingerprint): one row per row of ``docs``."""
    rows = with_successors(docs, id_col, text_col).where("NOT extra").drop("successor", "extra")
    got = signed(rows.withColumnRenamed("nth", "entry"), ["doc_id"], slots=slots)
    return got.select("doc_id", "signature", as_text(F.col("signature")).alias("fingerprint"))


def op13_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    rows = with_successors(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                      F.substring(F.col("successor"), F.lit(1), half))
    rows = rows.select("bin", "nth", "doc_id", n.cast("long").alias("n_chars"), "text",
                       F.when(~F.col("extra"), edited).alias("edited"))
    # Entry 2 nth is the document, 2 nth + 1 its edited text: successors stay neighbours.
    forms = F.array(F.struct(F.lit(0).alias("form"), F.col("text").alias("text")),
                    F.struct(F.lit(1).alias("form"), F.col("edited").alias("text")))
    rows = rows.select("bin", "nth", "doc_id", "n_chars", F.inline(forms)).where("text IS NOT NULL")
    digest = F.when(F.col("form") == 1, F.sha2("text", 256))
    rows = rows.select(
        "bin", (F.col("nth") * 2 + F.col("form")).alias("entry"), "text", "doc_id", "n_chars",
        *[F.conv(F.substring(digest, 16 * k + 1, 16), 16, -10).cast("long").alias(f"sha{k}") for k in range(4)])
    shas = [f"sha{k}" for k in range(4)]
    got = signed(rows, ["doc_id", "n_chars", *shas])
    order = Window.partitionBy("bin").orderBy("entry")
    sha = F.concat(*[F.lpad(F.lower(F.hex(F.lead(s).over(order))), 16, "0") for s in shas])
    got = got.select(
        "entry", "doc_id", "n_chars", sha.alias("edited_sha256"), "signature",
        F.lead("entry").over(order).alias("next_entry"),
        F.lead("signature").over(order).alias("edited"), F.lead("signature", 2).over(order).alias("following"))
    # A document's own entries: even ones followed by their edited text.
    got = got.where((F.col("entry") % 2 == 0) & (F.col("next_entry") == F.col("entry") + 1))
    return got.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("signature")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited")).alias("near_edited"),
        likeness(F.col("signature"), F.col("following")).alias("near_next"))
