"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_NUMBER = "_row_number"


def _orderable(df: DataFrame, column: str) -> Column:
    """The column, or an equivalent that can be sorted."""
    return F.to_json(column) if "map<" in df.schema[column].dataType.simpleString() else F.col(column)


def latest_per_key(
    df: DataFrame,
    key: str,
    order_by: str = "_ingested_at",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``order_by`` for each key.

    All rows of one ingest share a timestamp, so ties are the normal case:
    ``tie_break`` columns (greatest first) decide them, or, when none are
    given, all columns in turn (greatest first, NULL last), so that the winner
    never depends on task order: rows that still tie are equal.

    Spark's limit on the row number is applied before the shuffle as well: a
    task sends at most one row per key, so a key that holds a third of all
    rows costs its reducer one row per upstream task.
    """
    if tie_break is None:
        ties = [_orderable(df, c).desc_nulls_last() for c in df.columns if c not in (key, order_by)]
    else:
        ties = [F.col(c).desc() for c in tie_break]
    newest_first = Window.partitionBy(key).orderBy(F.col(order_by).desc(), *ties)
    ranked = df.withColumn(ROW_NUMBER, F.row_number().over(newest_first))
    return ranked.filter(F.col(ROW_NUMBER) == 1).drop(ROW_NUMBER)
