"""Rows of a query from Spark and from DuckDB, made comparable."""

from __future__ import annotations

import os
from decimal import Decimal

import duckdb

from cueflow.sources.tables import TABLES


def duck(sf_dir: str):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def plain(x):
    if isinstance(x, Decimal):
        return int(x) if x == x.to_integral_value() else float(x)
    if isinstance(x, float):
        return round(x, 9)
    return [plain(y) for y in x] if isinstance(x, list) else x


def spark_rows(df) -> list:
    cols = sorted(df.columns)
    return sorted(([plain(r[c]) for c in cols] for r in df.collect()), key=repr)


def duck_rows(con, sql: str, columns: list[str]) -> list:
    r = con.execute(sql)
    names = [d[0] for d in r.description]
    assert sorted(names) == sorted(columns), (sorted(names), sorted(columns))
    order = [names.index(c) for c in sorted(names)]
    return sorted(([plain(row[i]) for i in order] for row in r.fetchall()), key=repr)
