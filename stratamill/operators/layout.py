"""Physical layout: compaction and clustering."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.functions.zcurve import bucket_of, interleave, quantile_bounds
from stratamill.session import setting

# Rows drawn to place the bucket bounds. They steer the layout only, never which rows there are.
BOUND_SAMPLE_ROWS = 10_000
BITS_PER_COLUMN = 6


def compact(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Few, even output files: small tasks are merged and large ones split at run time."""
    return df.hint("rebalance", *partition_by)


@contextmanager
def target_file_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """Within the block, rebalanced and coalesced partitions aim at ``size`` bytes."""
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{size}b"):
        yield


def z_value(df: DataFrame, columns: Sequence[str], bits: int = BITS_PER_COLUMN) -> Column:
    """Z-order value of a row over ``columns``.

    Each column is cut into ``2**bits`` quantile buckets, so the curve follows
    the data, text included, and a skewed column does not waste bits.
    """
    rows = df.count()
    fraction = min(1.0, BOUND_SAMPLE_ROWS / rows) if rows else 1.0
    drawn = df.select(*columns).sample(fraction=fraction, seed=7).collect()
    buckets = [bucket_of(F.col(c), quantile_bounds([row[c] for row in drawn], 2**bits)) for c in columns]
    return interleave(buckets, bits)


def cluster(
    df: DataFrame,
    columns: Sequence[str],
    *,
    files: int | None = None,
    partition_by: Sequence[str] = (),
    spread: Column | None = None,
) -> DataFrame:
    """Rows with close values of ``columns`` end up in the same output partition, in order.

    One column gives a range sort, several a z-order. ``spread`` separates
    rows with equal values, so that one hot value is cut over several output
    partitions; it must be the same when a task is run again. The default, a
    hash of the row, cannot separate exact copies; a file position can.
    """
    overlap = set(columns) & set(partition_by)
    if overlap:
        raise ValueError(f"cannot cluster by partition columns: {sorted(overlap)}")
    if not columns:
        raise ValueError("no clustering columns; use compact()")
    bits = max(BITS_PER_COLUMN, -(-max(files or 1, 1).bit_length() // len(columns)) + 2)
    order = F.col(columns[0]) if len(columns) == 1 else z_value(df, columns, bits)
    placed = df.withColumns(
        {"_cluster": order, "_spread": spread if spread is not None else F.xxhash64(*[F.col(c) for c in df.columns])}
    )
    keys = [*partition_by, "_cluster", *columns, "_spread"]
    ranged = placed.repartitionByRange(files, *keys) if files else placed.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*partition_by, "_cluster", *columns).drop("_cluster", "_spread")
