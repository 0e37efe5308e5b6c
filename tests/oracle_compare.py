"""Run a registered query on Spark and its SQL twin on DuckDB; compare as multisets.

Both results are brought to pandas with columns sorted by name; values are compared exactly
(floats included), rows order-insensitively.
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [c for c in sorted(columns)], Counter(tuple(_norm(r[i]) for i in order) for r in records)


def spark_rows(df):
    cols = df.columns
    return rows_of(cols, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return rows_of(cols, cur.fetchall())


def compare(spark_df, con, sql) -> tuple[bool, str]:
    sc, sr = spark_rows(spark_df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if sum(sr.values()) != sum(dr.values()):
        return False, f"row counts differ: spark={sum(sr.values())} duck={sum(dr.values())}"
    if sr != dr:
        only_s = list((sr - dr).elements())[:3]
        only_d = list((dr - sr).elements())[:3]
        return False, f"values differ ({sum((sr - dr).values())} rows): spark-only={only_s} duck-only={only_d}"
    return True, f"{sum(sr.values())} rows"
