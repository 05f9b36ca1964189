"""Published tables: immutable Parquet directories plus a short list of live ones.

Parquet has no merge and cannot be overwritten while it is read. A table root
therefore looks like this::

    root/snapshot=<id>/...        data, written once, never changed
    root/published/version=<n>-<id>    text: the live directories, one per line

A line that begins with ``#`` is a mark: a name and a number that become visible together
with the directories, such as how much of a source is merged into them.

A directory is ``snapshot=<id>`` or, for a partitioned table, one partition in
it, so the list grows with the number of partitions, not with the rows. Once an upsert
has replaced some files of a directory, the files that are left are listed one by one in
its place, until the partition is laid out anew. Data is written first, may be checked,
and becomes visible when its version is written; a job that dies before that leaves the
table as it was. Each table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.operators.upsert import accept_newer, untouched_rows
from stratamill.session import setting
from stratamill.sinks.written import written_once

# Batches of at most this many keys are looked up one by one in the files' bloom filters.
LOOKUP_KEYS = 1000
# A filter's errors add up over the keys of a batch: at this rate, 1,000 keys open one file in a hundred for nothing.
LOOKUP_ERROR = 1e-5
LOOKUP_MAX_BYTES = 8 * 1024 * 1024


def file_of(file_path: Column) -> Column:
    """A data file relative to its table root."""
    return F.concat(F.lit("snapshot="), F.substring_index(file_path, "snapshot=", -1))


def is_file(entry: str) -> bool:
    """Whether an entry of the live list is a single file."""
    return entry.endswith(".parquet")


def partition_of(entry: str) -> str:
    """The partition that an entry of the live list belongs to; empty for an unpartitioned table."""
    directory = entry.rsplit("/", 1)[0] if is_file(entry) else entry
    return directory.removeprefix(directory.split("/")[0])


def directory_of(file_path: Column) -> Column:
    """Directory of a data file relative to its table root, from plain string functions."""
    below = F.substring_index(file_path, "snapshot=", -1)
    file_name = F.substring_index(file_path, "/", -1)
    return F.concat(F.lit("snapshot="), F.left(below, F.length(below) - F.length(file_name) - F.lit(1)))


def _lists(spark: SparkSession, root: str) -> dict[int, str]:
    """Paths of the published lists by version; none for a table that does not exist.

    A list counts once it has a data file. One that a crash left half-written has none,
    and its name is never used again, so it is in nobody's way.
    """
    try:
        files = spark.read.schema("value string").text(f"{root}/published").inputFiles()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    names = sorted({path.rsplit("/version=", 1)[1].split("/")[0] for path in files})
    return {int(name.split("-")[0]): f"{root}/published/version={name}" for name in names}


def _newest_list(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Number and path of the newest published list; 0 and None for a table that does not exist."""
    lists = _lists(spark, root)
    newest = max(lists, default=0)
    return newest, lists.get(newest)


def current_version(spark: SparkSession, root: str) -> int:
    """Number of the newest published version, 0 for a table that does not exist."""
    return _newest_list(spark, root)[0]


def _lines(spark: SparkSession, root: str) -> list[str]:
    _, path = _newest_list(spark, root)
    return sorted(row.value for row in spark.read.text(path).collect()) if path else []


def live_directories(spark: SparkSession, root: str) -> list[str]:
    """The live directories, or single files of one, relative to ``root``; empty for a table that does not exist."""
    return [line for line in _lines(spark, root) if not line.startswith("#")]


def directories_at(spark: SparkSession, root: str, version: int) -> list[str] | None:
    """What was live in one version; None if its list is gone."""
    path = _lists(spark, root).get(version)
    if path is None:
        return None
    return sorted(row.value for row in spark.read.text(path).collect() if not row.value.startswith("#"))


def live_marks(spark: SparkSession, root: str) -> dict[str, int]:
    """The marks of the live version."""
    marks = (line[1:].rsplit("=", 1) for line in _lines(spark, root) if line.startswith("#"))
    return {name: int(number) for name, number in marks}


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # Spark's name for it


def read_directories(
    spark: SparkSession, root: str, directories: Sequence[str], like: Sequence[str] = ()
) -> DataFrame:
    """Rows of the given directories; partition columns come back from the paths.

    One job writes one snapshot with one schema, so the merged schema is taken
    from one directory per snapshot instead of from every footer. Partition
    values are numbers or dates. A partition column that is NULL in all of the
    directories has the type it has in the directories ``like``.
    """
    reader = spark.read.option("basePath", root)
    typed_last = sorted([*like, *directories], key=lambda d: (NULL_PARTITION not in d, d in directories))
    one_per_snapshot = {d.split("/")[0]: f"{root}/{d}" for d in typed_last}
    merged = spark.read.option("basePath", root).option("mergeSchema", True).parquet(*one_per_snapshot.values()).schema
    from_paths = {level.split("=")[0] for d in directories for level in d.split("/") if "=" in level}
    stored = T.StructType([f for f in merged.fields if f.name not in from_paths])
    rows = reader.schema(stored).parquet(*[f"{root}/{d}" for d in directories]).drop("snapshot")
    known = {f.name: f.dataType for f in merged.fields if not isinstance(f.dataType, T.NullType)}
    all_null = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.NullType)]
    return rows.withColumns({c: F.col(c).cast(known.get(c, T.StringType())) for c in all_null}) if all_null else rows


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The live rows of a table."""
    live = live_directories(spark, root)
    if not live:
        raise FileNotFoundError(f"nothing published at {root}")
    return read_directories(spark, root, live)


def _lookup_options(key: str) -> dict[str, Any]:
    """Writer options for a bloom filter over the key in every row group, sized by its number of keys."""
    return {
        f"parquet.bloom.filter.enabled#{key}": True,
        f"parquet.bloom.filter.fpp#{key}": LOOKUP_ERROR,
        "parquet.bloom.filter.max.bytes": LOOKUP_MAX_BYTES,
        "parquet.bloom.filter.adaptive.enabled": True,
    }


def stage(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    *,
    rebalance: bool = True,
    mark: str = "rows",
    lookup: str | None = None,
) -> list[str]:
    """Write rows to a fresh snapshot, not yet visible; returns its directories.

    Rows are rebalanced by the partition columns first: one partition comes
    from few tasks instead of from all of them, and adaptive execution splits
    a partition that holds much of the data. Pass ``rebalance=False`` for
    rows that are already laid out. ``mark`` starts the snapshot's name. Files carry
    a bloom filter over the column ``lookup``.
    """
    spark = df.sparkSession
    snapshot = f"snapshot={mark}-{uuid.uuid4().hex}"
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    options = _lookup_options(lookup) if lookup else {}
    df.write.mode("error").options(**options).partitionBy(*partition_by).parquet(f"{root}/{snapshot}")
    if not partition_by:
        return [snapshot]
    files = list_files(spark, root, [snapshot])
    return sorted(row.directory for row in files.select("directory").distinct().collect())


def list_files(spark: SparkSession, root: str, directories: Sequence[str]) -> DataFrame:
    """The data files of some entries of a list: ``entry``, ``directory``, ``file``, ``path``, ``length``.

    Reads no contents. ``file`` is relative to the table root.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    files = reader.load([f"{root}/{d}" for d in directories])
    by_file = {d.rsplit("/", 1)[0] for d in directories if is_file(d)}
    directory, file = directory_of(F.col("path")), file_of(F.col("path"))
    entry = F.when(directory.isin(*by_file), file).otherwise(directory) if by_file else directory
    return files.select(entry.alias("entry"), directory.alias("directory"), file.alias("file"), "path", "length")


def publish(
    spark: SparkSession, root: str, directories: Sequence[str], marks: Mapping[str, int] | None = None
) -> int:
    """Make exactly these directories the live state; returns the new version.

    Without ``marks`` the version keeps those of the one before.
    """
    marks = live_marks(spark, root) if marks is None else marks
    version = current_version(spark, root) + 1
    lines = [*directories, *[f"#{name}={number}" for name, number in sorted(marks.items())]]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    frame.coalesce(1).write.mode("error").text(f"{root}/published/version={version}-{uuid.uuid4().hex}")
    return version


def replace_published(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """Full refresh; the new rows may have another schema."""
    return publish(df.sparkSession, root, stage(df, root, partition_by))


def files_holding(table: DataFrame, incoming: DataFrame, key: str) -> list[str]:
    """Files of ``table``, relative to its root, with a row whose key comes in; NULL keys are in none.

    Up to ``LOOKUP_KEYS`` keys are looked for by value: the files' minima, maxima and bloom
    filters tell which row groups can hold one, only those are read, and nothing is moved. More keys
    bound the search by the smallest and the largest of them, which skips most of the table
    if new keys follow old ones; then two 64-bit hashes per row within the bounds are moved, of the
    key and of the file. Keys that collide can only name a file too many, which is
    then rewritten as it was.
    """
    spark = table.sparkSession
    keys = incoming.filter(F.col(key).isNotNull()).select(key)
    few = [row[0] for row in keys.limit(LOOKUP_KEYS + 1).collect()]
    if not few:
        return []
    path = F.col("_metadata.file_path")
    if len(few) <= LOOKUP_KEYS:
        with setting(spark, "spark.sql.parquet.pushdown.inFilterThreshold", LOOKUP_KEYS):
            found = table.filter(F.col(key).isin(few)).select(file_of(path).alias("file")).distinct().collect()
        return sorted(row.file for row in found)
    least, most = keys.agg(F.min(key), F.max(key)).first()
    held = table.filter(F.col(key).between(least, most)).select(
        F.xxhash64(key).alias("key_hash"), F.xxhash64(file_of(path)).alias("file_hash")
    )
    hit = held.join(keys.select(F.xxhash64(key).alias("key_hash")), "key_hash", "left_semi").select("file_hash").distinct()
    names = spark.createDataFrame([(f,) for f in table.inputFiles()], "path string").select(file_of(F.col("path")).alias("file"))
    found = names.withColumn("file_hash", F.xxhash64("file")).join(hit, "file_hash", "left_semi")
    return sorted(row.file for row in found.select("file").collect())


def _without(spark: SparkSession, root: str, live: Sequence[str], files: Sequence[str]) -> list[str]:
    """The live list without some files: their directories are replaced by the files left in them."""
    gone, broken = set(files), {f.rsplit("/", 1)[0] for f in files}
    opened = [d for d in live if d in broken]
    left = {row.file for row in list_files(spark, root, opened).select("file").collect()} if opened else set()
    return sorted((({*live} - {*opened}) | left) - gone)


def stage_upsert(
    source: DataFrame,
    root: str,
    key: str,
    partition_by: Sequence[str] = (),
    order_by: str | None = None,
) -> list[str]:
    """Write what an upsert of ``source`` needs; returns the directories and files live after it.

    The source (each key once) is written first and read back from there, so
    it is computed once. Live files that hold one of its keys are rewritten without
    those rows; all others stay as they are, those of the same directory too. A row that
    moves to another partition is thus gone from its old one, and a partition
    that loses its last row is no longer listed. With ``order_by`` the batch is compared
    with the files that hold its keys, not with the table.
    """
    spark = source.sparkSession
    live = live_directories(spark, root)
    if not live:
        return stage(source, root, partition_by, lookup=key)
    table = read_directories(spark, root, live)
    if order_by is not None:
        source = written_once(source)
        rivals = files_holding(table, source, key)
        if rivals:
            source = accept_newer(source, read_directories(spark, root, rivals, like=live), key, order_by)
    incoming = stage(source, root, partition_by, lookup=key)
    if not incoming:
        return live
    incoming_rows = read_directories(spark, root, incoming, like=live)
    if order_by is not None and rivals:
        table = read_directories(spark, root, rivals, like=live)
    hit = files_holding(table, incoming_rows, key)
    if not hit:
        return sorted({*live, *incoming})
    touched = read_directories(spark, root, hit, like=live)
    kept = stage(untouched_rows(touched, incoming_rows, key), root, partition_by, lookup=key)
    return sorted({*_without(spark, root, live, hit), *incoming, *kept})


def upsert_published(
    source: DataFrame,
    root: str,
    key: str,
    partition_by: Sequence[str] = (),
    order_by: str | None = None,
) -> int:
    """Merge ``source`` into a published table by key and publish the result."""
    return publish(source.sparkSession, root, stage_upsert(source, root, key, partition_by, order_by))
