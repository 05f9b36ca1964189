"""Merging a batch into a table by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accept_newer(source: DataFrame, target: DataFrame, key: str, order_by: str) -> DataFrame:
    """Source rows that are not older than the target's row of the same key."""
    held = target.select(F.col(key).alias("_held_key"), F.col(order_by).alias("_held_order"))
    held_is_newer = (F.col(key) == F.col("_held_key")) & (F.col("_held_order") > F.col(order_by))
    return source.join(held, held_is_newer, "left_anti")


def untouched_rows(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key the source does not carry (NULL keys never match)."""
    return target.join(source.select(key), key, "left_anti")


def upsert(target: DataFrame, source: DataFrame, key: str, order_by: str | None = None) -> DataFrame:
    """Target after the merge: matching rows replaced whole, new rows added, none deleted.

    The source must hold each key once. By default its row wins even when it
    is older; with ``order_by`` an older source row is ignored. Columns only
    one side has are NULL for the other side's rows.
    """
    if order_by is not None:
        source = accept_newer(source, target, key, order_by)
    return untouched_rows(target, source, key).unionByName(source, allowMissingColumns=True)
