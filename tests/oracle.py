"""Compare a Spark result with DuckDB SQL as sorted rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return repr(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """(spark rows, sql rows, differing rows of either side)"""
    names = spark_df.columns
    got = canon([tuple(r) for r in spark_df.collect()], names)
    res = con.execute(sql)
    sql_names = [d[0] for d in res.description]
    assert sorted(sql_names) == sorted(names), (names, sql_names)
    want = canon(res.fetchall(), sql_names)
    from collections import Counter

    a, b = Counter(got), Counter(want)
    return len(got), len(want), list((a - b).elements()), list((b - a).elements())
