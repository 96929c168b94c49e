"""Broadcast only what has a measured size bound.

A side is broadcast when the caller can state an upper bound on its size from
measured facts (row counts of a stored table, fixed row widths, a bounded
construction such as one row per partition).  Above the limit the plain join is
returned and Spark shuffles both sides on the key; AQE can still split skewed
partitions of that shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONF_KEY = "tonality.broadcast.maxBytes"
DEFAULT_LIMIT = 256 * 1024 * 1024


def broadcast_limit(spark: SparkSession) -> int:
    value = spark.conf.get(CONF_KEY, None)
    return int(value) if value else DEFAULT_LIMIT


def bounded_broadcast(df: DataFrame, bound_bytes: int | None,
                      limit: int | None = None) -> DataFrame:
    """``broadcast(df)`` when ``bound_bytes`` is known and within the limit, else ``df``."""
    if bound_bytes is None:
        return df
    limit = broadcast_limit(df.sparkSession) if limit is None else limit
    return F.broadcast(df) if bound_bytes <= limit else df


def tiny(df: DataFrame) -> DataFrame:
    """Broadcast a side whose row count is bounded by construction.

    Only for frames such as one row per shuffle partition, one row per class, or
    a global aggregate: callers document the bound where they use it.
    """
    return F.broadcast(df)
