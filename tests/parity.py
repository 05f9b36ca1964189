"""Side-by-side comparison of a Spark query and its SQL in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(sf_dir) / name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, Counter(tuple(_cell(v) for v in row) for row in frame.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_cell(row[i]) for i in order) for row in cursor.fetchall())


def differences(spark: SparkSession, query, sql: str, sf_dir: str) -> str | None:
    """None when both give the same columns and the same rows, exactly."""
    spark_names, left = spark_rows(query(spark, sf_dir))
    duck_names, right = duck_rows(duck(sf_dir), sql)
    if spark_names != duck_names:
        return f"columns differ: {spark_names} / {duck_names}"
    if left != right:
        only_left, only_right = left - right, right - left
        return (
            f"{sum(left.values())} / {sum(right.values())} rows; {sum(only_left.values())} only in Spark,"
            f" e.g. {next(iter(only_left), None)}; only in SQL, e.g. {next(iter(only_right), None)}"
        )
    return None
