"""Spark result against DuckDB SQL on the same tables."""

from collections import Counter

import duckdb

TABLES = "documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return float(f"{v:.10g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def counted(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in records)


def same_as_duckdb(df, sql, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    got, want = counted(df.columns, [tuple(r) for r in df.collect()]), counted(columns, cur.fetchall())
    assert got == want
    return got
