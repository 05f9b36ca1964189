"""Left joins from transactions to their dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPEATS = "_repeats"


def with_dimension(facts: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left-join the named dimension columns; facts without a match keep NULLs.

    Only the key and the wanted columns enter the join: both sides carry
    lineage columns of the same names, and the rest would be shuffled for
    nothing. No side is hinted: Spark broadcasts the dimension when its
    size is under the session's limit, and otherwise splits hot keys of the
    fact side at run time.
    """
    return facts.join(dimension.select(key, *columns), key, "left")


def with_counted_dimension(facts: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left-join the named dimension columns, equal dimension rows once, with their number in ``REPEATS``.

    Facts without a match keep NULLs and count once. What is unique by the key before the join is
    unique by the key and the columns after it, so sums need no second aggregation, only a factor.
    """
    counted = dimension.groupBy(key, *columns).agg(F.count(F.lit(1)).alias(REPEATS))
    joined = with_dimension(facts, counted, key, [*columns, REPEATS])
    return joined.withColumn(REPEATS, F.coalesce(REPEATS, F.lit(1)))


def enrich(transactions: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Every transaction with its customer's country and its product's category."""
    with_country = with_dimension(transactions, customers, "customer_id", ["country_code"])
    return with_dimension(with_country, products, "product_id", ["category"])
