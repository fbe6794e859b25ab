"""Compare a Spark result with a SQL result: columns and all values."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, decimal.Decimal):
        return float(f"{float(value):.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def difference(spark_result, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both results are equal, else what differs."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    expected_rows = answer.fetchall()
    if sorted(names) != sorted(spark_result.columns):
        return f"columns {sorted(spark_result.columns)} and {sorted(names)}"
    order = sorted(names)
    expected = Counter(tuple(_plain(r[names.index(c)]) for c in order) for r in expected_rows)
    got_rows = spark_result.select(*[f"`{c}`" for c in order]).collect()
    got = Counter(tuple(_plain(v) for v in r) for r in got_rows)
    if got != expected:
        extra, lacking = list((got - expected).items())[:2], list((expected - got).items())[:2]
        return f"rows {len(got_rows)} and {len(expected_rows)}; extra {str(extra)[:600]}; lacking {str(lacking)[:600]}"
    return None
