"""Input spreading.

A scan narrower than the cluster (e.g. one large file with a single row group)
would run all per-row text work in one task.  ``spread`` hash-partitions such a
scan on the key the next per-key operator needs (``doc_id``), so the text work is
spread over the cluster *and* the later window / aggregate by that key finds its
distribution already satisfied (one exchange instead of two).  A scan that is
already at least as wide as the cluster is returned unchanged: at scale this is a
no-op and the plan keeps its single exchange on the token rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_WIDTH: dict[str, int] = {}


def scan_width(df: DataFrame, key: str) -> int:
    """Partitions of a scan, or of a narrow projection of one (computing them lists
    files; no job runs).  ``key`` names the scan for memoisation."""
    if key not in _WIDTH:
        _WIDTH[key] = df.rdd.getNumPartitions()
    return _WIDTH[key]


def spread(df: DataFrame, key_col: str, scan_key: str) -> DataFrame:
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        width = scan_width(df, scan_key)
    except Exception:  # noqa: BLE001 - sessions without the RDD API (Spark Connect)
        return df
    if width >= target:
        return df
    return df.repartition(key_col)


# Target bytes per partition for data that an iterative job re-reads every iteration.
ITERATIVE_PARTITION_BYTES = 128 * 1024 * 1024


def right_size(df: DataFrame, row_bytes: int, target: int = ITERATIVE_PARTITION_BYTES) -> DataFrame:
    """Coalesce a (checkpointed or cached) input of an iterative job to about
    ``rows x row_bytes / target`` partitions.

    Every iteration of L-BFGS or of the averaging rounds is a job with one task per
    partition, so a few-megabyte training set spread over many partitions spends its
    time scheduling; at scale the formula still yields thousands of partitions.
    Only ever reduces the partition count (no shuffle).
    """
    rows = df.count()
    want = max(1, -(-rows * row_bytes // target))
    try:
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - sessions without the RDD API (Spark Connect)
        return df
    return df.coalesce(want) if want < have else df
