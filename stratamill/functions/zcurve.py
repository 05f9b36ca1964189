"""Z-order values from built-in expressions: quantile buckets, interleaved bits."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def quantile_bounds(values: Sequence[Any], buckets: int) -> list[Any]:
    """Distinct upper bounds that cut sorted ``values`` into ``buckets`` parts."""
    ordered = sorted(v for v in values if v is not None)
    if not ordered:
        return []
    cuts = [ordered[len(ordered) * i // buckets] for i in range(1, buckets)]
    return sorted(set(cuts))


def bucket_of(column: Column, bounds: Sequence[Any]) -> Column:
    """Number of bounds at or below the value; NULL goes to bucket 0.

    A balanced tree of comparisons: 63 bounds cost six of them per row.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low).cast("bigint")
        middle = (low + high) // 2
        return F.when(column < F.lit(bounds[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return F.when(column.isNull(), F.lit(0).cast("bigint")).otherwise(search(0, len(bounds)))


def interleave(buckets: Sequence[Column], bits: int) -> Column:
    """Bit ``b`` of bucket ``i`` lands at position ``b * len(buckets) + i``.

    A bucket is used once per bit, so Spark computes it once per row, in a
    method of its own that stays small enough to be compiled.
    """
    if bits * len(buckets) > 63:
        raise ValueError("too many bits for one bigint z-value")
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, bucket in enumerate(buckets):
            picked = F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("bigint"))
            z = z.bitwiseOR(F.shiftleft(picked, bit * len(buckets) + place))
    return z
