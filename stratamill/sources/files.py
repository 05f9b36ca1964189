"""Raw feed files: format dispatch and selection by modification time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

FEED_FORMATS = ("csv", "json", "parquet")

# Spark's error conditions for "there is nothing at this path".
NO_DATA = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def utc_text(moment: dt.datetime) -> str:
    """The instant as UTC text; a naive value is taken as UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return moment.isoformat(timespec="microseconds")


def read_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "csv",
    *,
    schema: str | None = None,
    infer_types: bool = False,
    since: dt.datetime | None = None,
    merge: bool = False,
    base: str | None = None,
    formats: Sequence[str] | None = FEED_FORMATS,
) -> DataFrame:
    """Read feed files of one format.

    CSV has a header row, and its columns are text unless ``infer_types`` asks
    for the extra pass that types them. Column names come from the header; a
    file whose header disagrees raises instead of being read by position.
    ``since`` keeps files modified strictly later. ``merge`` takes the columns of
    all files instead of one's, where the format stores them. ``base`` is the folder
    below which folder names are partition columns, where ``paths`` are single
    files. ``formats`` lists what is accepted; None hands any format name to Spark.
    """
    if formats is not None and fmt not in formats:
        raise ValueError(f"unsupported feed format: {fmt}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False).option("inferSchema", infer_types)
    if merge:
        reader = reader.option("mergeSchema", True)
    if base is not None:
        reader = reader.option("basePath", base)
    if since is not None:
        reader = reader.option("modifiedAfter", utc_text(since)).option("timeZone", "UTC")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load([paths] if isinstance(paths, str) else list(paths))


def read_new_files(spark: SparkSession, paths: str | Sequence[str], fmt: str = "csv", **options) -> DataFrame | None:
    """As :func:`read_files`, or None when no file qualifies. Other errors pass through."""
    try:
        frame = read_files(spark, paths, fmt, **options)
    except AnalysisException as error:
        if error.getCondition() in NO_DATA:
            return None
        raise
    return None if frame.isEmpty() else frame
