"""Bronze tables as immutable batches, with lists of what is live.

::

    root/batch=<first>-<last>-<token>/_date_part=<day>/...   rows, written once
    root/_ingested/published/version=...     the ingest's list: every day directory it added
    root/_compacted/published/version=...    the upkeep's list: day directories that replace others

A batch becomes visible with the list that names it. The two lists have one writer each, so
days are compacted while the ingest goes on. Batches are numbered in the order in which they
were added; a compacted directory carries the numbers of the first and the last batch in it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.operators.layout import compact, target_file_bytes
from stratamill.sinks.published import live_directories, publish

DAY = "_date_part"
_NAME = re.compile(rf"batch=(\d+)-(\d+)-[^/]+(?:/{DAY}=([^/]+))?")


def token_of(parts: Iterable[str]) -> str:
    """The same for the same parts in any order."""
    return hashlib.sha256("\n".join(sorted(parts)).encode()).hexdigest()[:32]


def last_batch(directory: str) -> int:
    """Number of the newest batch that a directory holds rows of."""
    return int(_NAME.match(directory)[2])


def day_of(directory: str) -> dt.date | None:
    day = _NAME.match(directory)[3]
    return dt.date.fromisoformat(day) if day and day[0].isdigit() else None


def _ingested(spark: SparkSession, root: str) -> list[str]:
    return live_directories(spark, f"{root}/_ingested")


def _compacted(spark: SparkSession, root: str) -> list[dict]:
    return [json.loads(line) for line in live_directories(spark, f"{root}/_compacted")]


def live_batches(spark: SparkSession, root: str) -> list[str]:
    """The live day directories, oldest batch first; empty for a table without batches."""
    # The upkeep's list first: what it replaces was in the ingest's list before.
    generations = _compacted(spark, root)
    replaced = {directory for line in generations for directory in line["replaces"]}
    held = {*_ingested(spark, root), *(line["directory"] for line in generations)}
    return sorted(held - replaced, key=lambda d: (last_batch(d), d))


def add_batch(df: DataFrame, root: str, token: str) -> bool:
    """Add stamped rows as the next batch, once per ``token``; False if that token is there already.

    An attempt that died before its list was written is overwritten by the next one.
    Each task writes the rows of its input split, so nothing is shuffled.
    """
    spark = df.sparkSession
    ingested = _ingested(spark, root)
    if any(directory.split("/")[0].endswith(f"-{token}") for directory in ingested):
        return False
    number = max(map(last_batch, ingested), default=0) + 1
    name = f"batch={number:012d}-{number:012d}-{token}"
    written = _write(df, root, name, "overwrite")
    if written:
        publish(spark, f"{root}/_ingested", [*ingested, *written])
    return True


def _write(df: DataFrame, root: str, name: str, mode: str) -> list[str]:
    """Write rows below a batch name; returns its day directories."""
    spark = df.sparkSession
    df.write.mode(mode).partitionBy(DAY).parquet(f"{root}/{name}")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    found = reader.load(f"{root}/{name}").select(F.regexp_extract("path", f"({DAY}=[^/]*)/[^/]*$", 1).alias("day"))
    return sorted(f"{name}/{row.day}" for row in found.distinct().collect())


def read_batches(
    spark: SparkSession, root: str, directories: Sequence[str], schema: str | T.StructType | None = None
) -> DataFrame:
    """Rows of some day directories. Without ``schema`` the footers of their files are merged."""
    reader = spark.read.option("basePath", root)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    rows = reader.parquet(*[f"{root}/{directory}" for directory in directories]).drop("batch")
    return rows.withColumn(DAY, F.col(DAY).cast("date")) if DAY in rows.columns else rows


def compact_days(
    spark: SparkSession, root: str, before: dt.date, file_bytes: int, schema: str | T.StructType | None = None
) -> int:
    """Rewrite each closed day that lies in several directories into one; returns the directories replaced.

    Closed are the days before ``before``: the ingest adds nothing to them any more. Rows and
    the day they were ingested stay as they are.
    """
    by_day: dict[dt.date, list[str]] = {}
    for directory in live_batches(spark, root):
        day = day_of(directory)
        if day is not None and day < before:
            by_day.setdefault(day, []).append(directory)
    ragged = sorted(d for found in by_day.values() if len(found) > 1 for d in found)
    if not ragged:
        return 0
    lines = [json.dumps(line) for line in _compacted(spark, root)]
    for day, directories in sorted(by_day.items()):
        if len(directories) < 2:
            continue
        numbers = [int(n) for d in directories for n in _NAME.match(d).groups()[:2]]
        name = f"batch={min(numbers):012d}-{max(numbers):012d}-{token_of(directories)}"
        with target_file_bytes(spark, file_bytes):
            written = _write(compact(read_batches(spark, root, directories, schema), (DAY,)), root, name, "overwrite")
        lines.append(json.dumps({"directory": written[0], "replaces": directories}))
        publish(spark, f"{root}/_compacted", lines)
    return len(ragged)
