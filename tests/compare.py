"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
            )
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, decimal.Decimal):
        return str(value.normalize() + 0)
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, (int, float)):
        return str(decimal.Decimal(str(value)).normalize() + 0)
    return str(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    values = (tuple(plain(r[i]) for i in order) for r in rows)
    return sorted(values, key=lambda r: [(c is None, c or "") for c in r])


def spark_rows(df):
    return canonical(df.columns, df.collect())


def oracle_rows(con, sql):
    result = con.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())
