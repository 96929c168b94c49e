"""The driver's parquet tables and cheap, measured facts about them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

_COUNTS: dict[tuple, int] = {}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def fingerprint(path: str) -> str:
    """Cheap identity of an input (size and mtime when the path is local)."""
    try:
        st = os.stat(path)
        return f"{st.st_size:x}{int(st.st_mtime):x}"
    except OSError:
        return "0"


def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Row count of an input table (parquet answers it from footers), memoised."""
    path = table_path(sf_dir, name)
    key = (os.path.abspath(path) if "://" not in path else path, fingerprint(path))
    if key not in _COUNTS:
        _COUNTS[key] = read_table(spark, sf_dir, name).count()
    return _COUNTS[key]
