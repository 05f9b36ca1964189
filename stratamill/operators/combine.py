"""Bringing several sources together."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.contracts import TableContract


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name; absent columns are NULL.

    A column that the frames give different types becomes text, so that one
    source's way of writing it never fails the union or loses another's values.
    """
    frames = list(frames)
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
    mixed = {name for name, found in kinds.items() if len(found - {"void"}) > 1}
    alike = [frame.withColumns({c: _as_text(frame, c) for c in frame.columns if c in mixed}) for frame in frames]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), alike)


def _as_text(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    return F.to_json(column) if nested else F.col(column).cast("string")


def union_positional(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column position."""
    return reduce(lambda left, right: left.union(right), frames)


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Give the contract's columns their declared types; other columns pass through.

    A value that does not fit its type becomes NULL, an absent column is added
    as NULL. Sources must be conformed before they are united: one may deliver
    ids as numbers and another as text.
    """
    typed = {
        name: (F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind))
        for name, kind in contract.columns.items()
    }
    return df.withColumns(typed)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column."""
    return df.select(column).distinct()
