"""Bronze tables: evolving append, tolerant read over all sources."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.contracts import TableContract
from stratamill.operators.combine import conform, union_sources
from stratamill.sources.batches import day_of, last_batch, live_batches, read_batches
from stratamill.sources.files import NO_DATA

logger = logging.getLogger(__name__)


def append_bronze(df: DataFrame, path: str) -> None:
    """Append stamped rows, partitioned by ingest date. New columns are allowed.

    Each task writes the rows of its input split, so nothing is shuffled.
    """
    df.write.mode("append").partitionBy("_date_part").parquet(path)


def read_bronze(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """One source's Bronze table: its live batches, or all its files if it has no list of them.

    Columns a file lacks are NULL. Without ``schema`` the footers of all files are merged
    (a distributed job); with one that pass is saved and only its columns are read.
    """
    live = live_batches(spark, path)
    if live:
        return read_batches(spark, path, live, schema)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def unmerged_bronze(
    spark: SparkSession,
    locations: Mapping[str, str],
    contract: TableContract,
    schemas: Mapping[str, str | T.StructType] | None = None,
    since: dt.date | None = None,
    merged: Mapping[str, int] | None = None,
) -> tuple[DataFrame | None, dict[str, int]]:
    """What a merge has to read, conformed and united, and the newest batch by source that is in it or before.

    Of a source with batches, those behind ``merged`` are read, or with ``since`` those
    ingested from that day on; no other directory is opened. A source without a list of
    batches is read as a whole, or from ``since`` on. None if there is nothing to read.

    ``schemas`` gives, by source, what its files may hold; for others the footers of the
    files read are merged. A source without data is logged and skipped; if none has any,
    this raises. Unreadable data or missing rights are errors, not empty sources.
    """
    merged, schemas = merged or {}, schemas or {}
    frames, marks, found = [], dict(merged), False
    for source, path in locations.items():
        live = live_batches(spark, path)
        if not live:
            frame = _whole(spark, path, schemas.get(source), since)
            if frame is None:
                logger.warning("no bronze data for %s from %s at %s", contract.name, source, path)
                continue
        else:
            found = True
            news = [d for d in live if last_batch(d) > merged.get(source, 0)]
            wanted = news if since is None else [d for d in live if (day_of(d) or dt.date.max) >= since]
            # A mark may pass only what is read now or was before.
            if set(news) <= set(wanted):
                marks[source] = max(map(last_batch, live))
            if not wanted:
                continue
            frame = read_batches(spark, path, wanted, schemas.get(source))
        frames.append(conform(frame, contract))
    if not frames and not found:
        raise RuntimeError(f"no bronze data for {contract.name} in any of {sorted(locations)}")
    return (union_sources(frames) if frames else None), marks


def _whole(spark: SparkSession, path: str, schema: str | T.StructType | None, since: dt.date | None) -> DataFrame | None:
    """All rows of a table without batches; None if there is nothing at the path."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    try:
        frame = reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in NO_DATA:
            raise
        return None
    return frame if since is None else frame.filter(F.col("_date_part") >= F.lit(since))


def read_all_bronze(
    spark: SparkSession,
    locations: Mapping[str, str],
    contract: TableContract,
    schemas: Mapping[str, str | T.StructType] | None = None,
    since: dt.date | None = None,
) -> DataFrame:
    """The table from every source that has it, conformed and united.

    ``since`` keeps the ingest dates from that day on, and only their partitions are
    read. Sources are treated as :func:`unmerged_bronze` treats them.
    """
    rows, _ = unmerged_bronze(spark, locations, contract, schemas, since)
    if rows is None:
        rows, _ = unmerged_bronze(spark, locations, contract, schemas)
        rows = rows.limit(0)
    return rows
