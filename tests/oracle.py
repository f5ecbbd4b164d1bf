"""Comparison of a query with its SQL counterpart."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str | None:
    """None if the results agree, else what differs."""
    result = connection.execute(sql)
    columns, expected = [c[0] for c in result.description], result.fetchall()
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(columns)}"
    got, want = rows_of(spark_df.columns, spark_df.collect()), rows_of(columns, expected)
    if got == want:
        return None
    return f"{sum(got.values())} rows instead of {sum(want.values())}; only here {list((got - want).items())[:3]}; missing {list((want - got).items())[:3]}"
