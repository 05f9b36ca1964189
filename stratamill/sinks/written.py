"""Intermediate results written once and read several times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for such data; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set")
    return tempfile.mkdtemp(prefix="run-")


def written_once(df: DataFrame) -> DataFrame:
    """The same rows, read from Parquet written now.

    For a frame with several readers behind an expensive shuffle: it is computed
    once, each reader scans only its columns, and a lost executor costs a
    re-read instead of the whole lineage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
