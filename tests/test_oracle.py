"""Every query with an oracle SQL equals DuckDB on the smallest scale factor."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from tonality.sources.tables import TABLES

SMOKE = "/root/testdata/sf0.001"
KEYS = sorted(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


def test_every_sql_key_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SMOKE)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[key])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _rows(cols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "split", "actual", "n", "score_pos", "score_neg", "predicted"]
    assert df.count() > 0
