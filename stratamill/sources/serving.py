"""Serving results by name: views over the current state, or tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratamill.sinks.published import read_published


def as_view(df: DataFrame, name: str) -> None:
    """Materialise as a view: evaluated when queried."""
    df.createOrReplaceTempView(name)


def as_table(df: DataFrame, name: str) -> None:
    """Materialise as a catalog table: evaluated once, replaced whole."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def serve(spark: SparkSession, root: str, name: str) -> None:
    """Expose the live state of a published table to SQL, schema taken from its files."""
    as_view(read_published(spark, root), name)
