"""Run a registered query and its SQL side by side and compare them row for row."""

from __future__ import annotations

import math
from datetime import date, datetime
from glob import glob
from os.path import basename

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    base = duckdb.connect()
    base.execute("SET TimeZone = 'UTC'")
    for path in glob(f"{folder}/*.parquet"):
        base.execute(f"CREATE VIEW {basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return base


def plain(value):
    if value is None or isinstance(value, (str, bool, int)):
        return value
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    rows = [tuple(plain(r[n]) for n in names) for r in df.collect()]
    return names, [kinds[n] for n in names], sorted(rows, key=repr)


def sql_rows(base, sql):
    result = base.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(r[i]) for i in order) for r in result.fetchall()]
    return sorted(names), [kinds[n] for n in sorted(names)], sorted(rows, key=repr)
