"""Exactly-once file ingest: each feed file enters Bronze once, however often this runs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from stratamill.operators.lineage import stamp
from stratamill.sources.batches import add_batch, token_of
from stratamill.sources.files import NO_DATA
from stratamill.streaming.feed_schema import read_feed_files, stored_schema

# The columns of Spark's file listing as a stream; only the paths are read.
_LISTING = "path string, modificationTime timestamp, length long, content binary"


def ingest_available(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    checkpoint: str,
    fmt: str,
    *,
    source: str,
    cloud: str,
    schema: str | None = None,
    max_files_per_batch: int = 10_000,
) -> bool:
    """Process every file the checkpoint has not seen, then stop.

    Returns False when there is no feed yet. The stream is one of file paths: the
    checkpoint says which files belong to which batch, and a batch is added to Bronze
    once, so a rerun, or a restart after a crash, neither skips nor repeats a file.
    Duplicates between files are left to Silver, which needs no stream state.

    Without ``schema`` the feed's own is used, kept beside the checkpoint and widened
    by exactly the files of a batch before they are read, so that a column arrives
    which only some files have, in any format, and old files are never read again for it.
    """
    store = f"{checkpoint}-schema"

    def take(listed: DataFrame, batch_id: int) -> None:
        paths = sorted(row.path for row in listed.select("path").collect())
        rows = read_feed_files(spark, raw_path, paths, fmt, store, schema) if paths else None
        if rows is not None:
            add_batch(stamp(rows, source, cloud), bronze_path, token_of(paths))

    reader = spark.readStream.format("binaryFile").schema(_LISTING).option("recursiveFileLookup", True)
    try:
        listed = reader.option("maxFilesPerTrigger", max_files_per_batch).load(raw_path).select("path")
        query = (
            listed.writeStream.foreachBatch(take)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    except AnalysisException as error:
        if error.getCondition() not in NO_DATA:
            raise
        return False
    query.awaitTermination()
    return schema is not None or stored_schema(spark, store) is not None
