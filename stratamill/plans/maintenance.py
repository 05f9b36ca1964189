"""Layout maintenance of published tables."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stratamill.operators.layout import cluster, compact, target_file_bytes
from stratamill.sinks.published import list_files, live_directories, partition_of, publish, read_directories, stage

logger = logging.getLogger(__name__)

TARGET_FILE_BYTES = 256 * 1024 * 1024
# Most data clustered by one job: its shuffle then has about 8,000 partitions.
CLUSTER_BATCH_BYTES = 2 * 1024**4
# A clustered partition is rewritten once this share of its bytes lies outside of the clustered files.
LOOSE_SHARE = 0.05


@dataclass(frozen=True)
class LayoutTask:
    """One table to maintain. Without ``cluster_by`` its small files are compacted.

    ``key`` names the column by which rows are looked up, if any.
    """

    label: str
    root: str
    cluster_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    key: str | None = None


def _fragmented(spark: SparkSession, root: str, live: Sequence[str], file_bytes: int) -> list[str]:
    """Live directories of partitions that hold more than one file below the target size."""
    partition = F.regexp_replace("directory", "^snapshot=[^/]+", "")
    small = list_files(spark, root, live).groupBy(partition.alias("partition")).agg(
        F.count_if(F.col("length") < file_bytes).alias("small_files")
    )
    ragged = {row.partition for row in small.filter("small_files > 1").select("partition").collect()}
    return [d for d in live if partition_of(d) in ragged]


def _unclustered(live: Sequence[str], mark: str) -> list[str]:
    """Live directories of partitions that are not one directory with this mark."""
    held = Counter(partition_of(d) for d in live)
    done = {partition_of(d) for d in live if d.startswith(f"snapshot={mark}-") and held[partition_of(d)] == 1}
    return [d for d in live if partition_of(d) not in done]


def compact_table(spark: SparkSession, task: LayoutTask, file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite the fragmented partitions into files near the target size; returns the directories rewritten."""
    live = live_directories(spark, task.root)
    ragged = _fragmented(spark, task.root, live, file_bytes)
    if ragged:
        with target_file_bytes(spark, file_bytes):
            rows = compact(read_directories(spark, task.root, ragged, like=live), task.partition_by)
            written = stage(rows, task.root, task.partition_by, rebalance=False, lookup=task.key)
        publish(spark, task.root, sorted({*live, *written} - set(ragged)))
    return len(ragged)


def _batches(sizes: Mapping[str, int], batch_bytes: int, file_bytes: int) -> Iterator[list[str]]:
    """Directories in groups of whole partitions, each group about ``batch_bytes`` or one partition.

    A partition of several files is a group of its own: the bounds that place its
    rows are then its own, not those of all months together.
    """
    batch, held = [], 0
    for _, group in groupby(sorted(sizes, key=partition_of), key=partition_of):
        directories = list(group)
        size = sum(sizes[d] for d in directories)
        if size > file_bytes:
            yield directories
            continue
        if batch and held + size > batch_bytes:
            yield batch
            batch, held = [], 0
        batch += directories
        held += size
    if batch:
        yield batch


def cluster_table(
    spark: SparkSession,
    task: LayoutTask,
    file_bytes: int = TARGET_FILE_BYTES,
    batch_bytes: int = CLUSTER_BATCH_BYTES,
    loose_share: float = LOOSE_SHARE,
) -> int:
    """Rewrite what is not yet clustered by the task's columns; returns the directories rewritten.

    A clustered snapshot carries its columns in its name, so a partition that
    no upsert has touched since is left alone, and the daily cost follows the
    changed partitions instead of the table. A few corrected rows leave a partition as it is,
    until ``loose_share`` of its bytes lies outside of the clustered files. Partitions are rewritten and
    published in batches, which keeps one shuffle's size in bounds and what is
    done when a later batch fails. Rows with equal values are told apart by
    their place in their file: a hot value, even one of identical rows, is
    spread over several output files.
    """
    live = live_directories(spark, task.root)
    if not live:
        raise FileNotFoundError(f"nothing published at {task.root}")
    mark = "by-" + "-".join(task.cluster_by)
    loose = _unclustered(live, mark)
    if not loose:
        return 0
    stored = list_files(spark, task.root, loose).groupBy("entry").agg(F.sum("length").alias("size"))
    sizes = {d: 0 for d in loose} | {row.entry: row.size for row in stored.collect()}
    total, outside = Counter(), Counter()
    for d, size in sizes.items():
        total[partition_of(d)] += size
        outside[partition_of(d)] += 0 if d.startswith(f"snapshot={mark}-") else size
    # Leftovers of one clustered snapshot are in order still; those of two are not.
    snapshots = {(partition_of(d), d.split("/")[0]) for d in loose if d.startswith(f"snapshot={mark}-")}
    runs = Counter(partition for partition, _ in snapshots)
    settled = {p for p, size in total.items() if runs[p] == 1 and outside[p] < loose_share * size}
    sizes = {d: size for d, size in sizes.items() if partition_of(d) not in settled}
    for batch in _batches(sizes, batch_bytes, file_bytes):
        placed = cluster(
            read_directories(spark, task.root, batch, like=live),
            task.cluster_by,
            files=max(1, -(-sum(sizes[d] for d in batch) // file_bytes)),
            partition_by=task.partition_by,
            spread=F.xxhash64("_metadata.file_path", "_metadata.row_index"),
        )
        written = stage(placed, task.root, task.partition_by, rebalance=False, mark=mark, lookup=task.key)
        live = sorted({*live, *written} - set(batch))
        publish(spark, task.root, live)
    return len(sizes)


def maintain(spark: SparkSession, tasks: Sequence[LayoutTask], file_bytes: int = TARGET_FILE_BYTES) -> dict[str, int]:
    """Maintain every table; one failure does not stop the others, and all are raised at the end."""
    rewritten, failed = {}, []
    for task in tasks:
        try:
            run = cluster_table if task.cluster_by else compact_table
            rewritten[task.label] = run(spark, task, file_bytes)
        except Exception:  # each table stands alone; the sweep reports all failures together
            logger.exception("layout maintenance of %s failed", task.label)
            failed.append(task.label)
    if failed:
        raise RuntimeError(f"layout maintenance failed for: {failed}")
    return rewritten
