"""Sequential numbering without a single-partition window.

``row_number() over (order by k)`` (no partition clause) and
``row_number() over (partition by <two-valued column> ...)`` route a whole table or
a third of it through one task.  ``global_ordinal`` instead cuts the order into bins at
bounds drawn once from a fixed-size hashed sample.  A row's bin is a data column, an
expression of its own keys and literal bounds, so every branch of a plan, every recomputed
task and every pruned copy of the frame agree on it.  Rows are ranked inside their bin and
each bin's offset is the count of the bins before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .broadcast import tiny

# Sampled rows per bin, and the most bins: the driver sees their product at most.
SAMPLE_PER_BIN = 32
MAX_BINS = 1024


def _at_or_after(order: Sequence[str], descending: Sequence[str], bound: Sequence) -> Column:
    """Whether a row stands at or after ``bound`` in the order (nulls count as smallest)."""
    result = F.lit(True)
    for name, value in reversed(list(zip(order, bound, strict=True))):
        x, b = F.col(name), F.lit(value)
        if name in descending:
            later = F.coalesce(x < b, x.isNull() & b.isNotNull())
        else:
            later = F.coalesce(x > b, x.isNotNull() & b.isNull())
        result = later | (x.eqNullSafe(b) & result)
    return result


def _bin(order: Sequence[str], descending: Sequence[str], bounds: Sequence[Sequence]) -> Column:
    """Number of bounds at or before the row, as a balanced tree of comparisons."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(_at_or_after(order, descending, bounds[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))
    return tree(0, len(bounds))


def global_ordinal(df: DataFrame, order: Sequence[str], out: str = "ordinal",
                   descending: Sequence[str] = ()) -> DataFrame:
    """Add ``out``: the 0-based position of each row in the order of the named columns,
    those in ``descending`` from high to low (nulls last there, first elsewhere).

    ``order`` must be a total order for the numbering to be unique; equal rows are
    neighbours in any case.  The number of bins follows ``spark.sql.shuffle.partitions``.
    """
    bins = max(1, min(MAX_BINS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    directions = [F.col(c).desc() if c in descending else F.col(c).asc() for c in order]
    # The rows of the smallest hashed keys: a fixed number, the same ones every time.
    sample = (df.select(*order).orderBy(F.xxhash64(*order), *directions)
              .limit(bins * SAMPLE_PER_BIN).orderBy(*directions).collect())
    cuts = [tuple(sample[len(sample) * k // bins]) for k in range(1, bins)] if sample else []
    cuts = [c for k, c in enumerate(cuts) if not k or c != cuts[k - 1]]
    binned = df.withColumn("_ord_bin", _bin(order, descending, cuts))
    sizes = binned.groupBy("_ord_bin").agg(F.count(F.lit(1)).alias("_ord_n"))
    before = Window.orderBy("_ord_bin").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bin: bounded by MAX_BINS.
    offsets = sizes.select(F.col("_ord_bin").alias("_ord_b"),
                           F.coalesce(F.sum("_ord_n").over(before), F.lit(0)).alias("_ord_base"))
    inside = Window.partitionBy("_ord_bin").orderBy(*directions)
    return (binned.withColumn("_ord_k", F.row_number().over(inside))
            .join(tiny(offsets), F.col("_ord_bin") == F.col("_ord_b"))
            .withColumn(out, (F.col("_ord_base") + F.col("_ord_k") - 1).cast("bigint"))
            .drop("_ord_bin", "_ord_b", "_ord_k", "_ord_base"))


def ordinal_within(df: DataFrame, groups: Sequence[str], order: Sequence[str],
                   out: str = "ordinal", descending: Sequence[str] = ()) -> DataFrame:
    """0-based position inside each group of a *low-cardinality* grouping.

    Built on ``global_ordinal`` over (groups, order): the group's start is the number of
    rows in the groups before it, one row per group, so the start table is bounded by the
    number of groups (callers pass groupings such as split x class).
    """
    ranked = global_ordinal(df, [*groups, *order], out="_ow_ordinal", descending=descending)
    before = Window.orderBy(*groups).rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_ow_n")).select(
        *[F.col(g).alias(f"_ow_{g}") for g in groups],
        F.coalesce(F.sum("_ow_n").over(before), F.lit(0)).alias("_ow_start"))
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_ow_{g}"))
    return (ranked.join(tiny(starts), same)
            .withColumn(out, F.col("_ow_ordinal") - F.col("_ow_start"))
            .drop("_ow_ordinal", "_ow_start", *[f"_ow_{g}" for g in groups]))


def top_by_count_candidates(counts: DataFrame, k: int, count_col: str = "n") -> DataFrame:
    """Rows that can rank among the first ``k`` by ``count_col`` descending.

    With c_k the k-th largest count, every row ranked before position k has a count
    >= c_k, and at most k - 1 rows have a count > c_k; so keeping ``count >= c_k``
    keeps all of the top k plus the ties at c_k, and ranks among the kept rows equal
    global ranks.  c_k comes from the histogram of counts (one row per distinct count
    value: at most sqrt(2 x total) rows when the counts sum to ``total``) through a
    scalar subquery, so the long tail is never sorted.  Fewer than k rows keeps all.
    """
    hist = counts.groupBy(count_col).agg(F.count(F.lit(1)).alias("_tk_k"))
    upto = Window.orderBy(F.col(count_col).desc()).rowsBetween(Window.unboundedPreceding, 0)
    threshold = (hist.withColumn("_tk_cum", F.sum("_tk_k").over(upto))
                 .where(F.col("_tk_cum") >= k).agg(F.max(count_col)))
    return counts.where(F.col(count_col) >= F.coalesce(threshold.scalar(), F.lit(0)))
