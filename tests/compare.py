"""Run registered queries next to their SQL and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def spark_rows(df):
    return rows_of(df.columns, df.collect())
