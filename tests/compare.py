"""Run a query in Spark and its check SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, list):
        return tuple(_plain(x) for x in v)
    return v


def _kind(v):
    return "float" if isinstance(v, float) else type(v).__name__


def rows(table) -> tuple[list[str], Counter]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, Counter(tuple((_kind(_plain(v)), _plain(v)) for v in row) for row in zip(*columns))


def difference(spark_df, con, sql: str) -> str | None:
    """``None`` if both agree, else a short description."""
    left_names, left = rows(spark_df.toArrow())
    result = con.sql(sql).to_arrow_table()
    right_names, right = rows(result)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (f"{sum(left.values())} rows against {sum(right.values())}; only in Spark {sum(only_left.values())}: "
            f"{[tuple(v for _, v in r) for r in list(only_left)[:2]]}; only in SQL {sum(only_right.values())}: "
            f"{[tuple(v for _, v in r) for r in list(only_right)[:2]]}")
