"""One result to several targets, by difference.

A list of live directories carries, as marks, a checksum of each directory's rows that does
not depend on their order. Directories never change, so a target that lists a directory with
the same checksum has it; only the others are copied, under their own names. What is copied
is read back and compared before the target lists it.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.sinks.published import (
    directory_of,
    is_file,
    live_directories,
    live_marks,
    publish,
    read_directories,
    stage,
)

logger = logging.getLogger(__name__)

DONE = "ok"
_SUM = "sum:"


def checksums(spark: SparkSession, root: str, directories: Sequence[str], like: Sequence[str] = ()) -> dict[str, int]:
    """By directory, the sum over its rows of their hashes: one row a directory reaches the driver."""
    if not directories:
        return {}
    rows = read_directories(spark, root, directories, like)
    columns = sorted(rows.columns)
    hashed = rows.select(
        directory_of(F.col("_metadata.file_path")).alias("directory"),
        F.xxhash64(F.lit(1), *columns).cast("decimal(20,0)").alias("hash"),
    )
    # The count goes with it: rows that hash to opposite numbers would cancel out.
    summed = hashed.groupBy("directory").agg(F.sum("hash").alias("sum"), F.count("*").alias("n"))
    found = {row.directory: int(row.sum) * 1_000_000_007 + row.n for row in summed.collect()}
    return {directory: found.get(directory, 0) for directory in directories}


def listed_checksums(spark: SparkSession, root: str) -> dict[str, int]:
    """The checksums that the live list carries."""
    return {name[len(_SUM) :]: n for name, n in live_marks(spark, root).items() if name.startswith(_SUM)}


def publish_with_checksums(spark: SparkSession, root: str, directories: Sequence[str], sums: Mapping[str, int]) -> int:
    """Publish directories with their checksums; other marks stay."""
    marks = {name: n for name, n in live_marks(spark, root).items() if not name.startswith(_SUM)}
    return publish(spark, root, directories, marks | {f"{_SUM}{d}": sums[d] for d in directories})


def _copy(spark: SparkSession, source: str, target: str, directories: Sequence[str], like: Sequence[str]) -> None:
    """Write directories under their own names; what a broken attempt left of them is overwritten."""
    by_snapshot: dict[str, list[str]] = {}
    for directory in directories:
        by_snapshot.setdefault(directory.split("/")[0], []).append(directory)
    for snapshot, own in by_snapshot.items():
        columns = [level.split("=")[0] for level in own[0].split("/")[1:]]
        writer = read_directories(spark, source, own, like).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic" if columns else "static").partitionBy(*columns).parquet(
            f"{target}/{snapshot}"
        )


def copy_difference(spark: SparkSession, source: str, target: str, directories: Sequence[str], check: bool = False) -> int:
    """Bring a target up to the source's published ``directories``; returns how many were copied.

    A directory is taken as copied if the target's list has it with the source's checksum;
    with ``check`` its rows are read as well. Raises if a copy does not come out right.
    """
    wanted = listed_checksums(spark, source)
    held = listed_checksums(spark, target)
    same = [d for d in directories if d in held and held[d] == wanted[d]]
    if check:
        try:
            real = checksums(spark, target, same, like=directories)
        except Exception as error:  # unreadable files are a broken copy, which is made again
            logger.warning("the copy at %s cannot be read: %s", target, error)
            real = {}
        same = [d for d in same if real.get(d) == wanted[d]]
    missing = sorted(set(directories) - set(same))
    if missing:
        _copy(spark, source, target, missing, like=directories)
        real = checksums(spark, target, missing, like=directories)
        broken = [d for d in missing if real[d] != wanted[d]]
        if broken:
            raise OSError(f"copies differ from their source: {broken}")
    if missing or sorted(live_directories(spark, target)) != sorted(directories):
        publish_with_checksums(spark, target, directories, wanted)
    return len(missing)


def replicate_directories(
    spark: SparkSession, name: str, directories: list[str], targets: Mapping[str, str], check: bool = False
) -> dict[str, str]:
    """Publish staged directories of the first target there and copy what the others lack.

    ``targets`` maps a label to a root under which tables live; the staged
    directories belong to the first one. A failing copy is logged and reported
    in its status and keeps no other target from its copy, and its target as it was; the
    next call goes on with it. A failing first target raises. Single files, which upserts
    leave in a list, cannot be copied under their names: lay the table out first.
    """
    if any(map(is_file, directories)):
        raise ValueError(f"{name} lists single files; compact or cluster it before it is copied")
    (first, first_root), *others = targets.items()
    source = f"{first_root}/{name}"
    known = listed_checksums(spark, source)
    fresh = checksums(spark, source, [d for d in directories if d not in known], like=directories)
    if fresh or sorted(live_directories(spark, source)) != sorted(directories):
        publish_with_checksums(spark, source, directories, known | fresh)
    status = {first: DONE}
    for label, root in others:
        try:
            copied = copy_difference(spark, source, f"{root}/{name}", directories, check)
            logger.info("%s: %d of %d directories copied to %s", name, copied, len(directories), label)
            status[label] = DONE
        except Exception as error:  # a target is outside our control; its failure is a result
            logger.error("could not write %s to %s: %s", name, label, error)
            status[label] = f"failed: {type(error).__name__}"
    return status


def repair(spark: SparkSession, name: str, targets: Mapping[str, str]) -> dict[str, str]:
    """Compare every copy of a published table with the first target's, by its rows, and mend what differs."""
    first_root = next(iter(targets.values()))
    return replicate_directories(spark, name, live_directories(spark, f"{first_root}/{name}"), targets, check=True)


def replicate(df: DataFrame, name: str, targets: Mapping[str, str]) -> dict[str, str]:
    """Compute ``df`` once, into the first target, and copy the result to the others."""
    first_root = next(iter(targets.values()))
    return replicate_directories(df.sparkSession, name, stage(df, f"{first_root}/{name}"), targets)
