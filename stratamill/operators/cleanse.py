"""Cleansing rules of the Silver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.functions.days import RunTime, run_time, to_day
from stratamill.functions.money import to_money
from stratamill.functions.text import tidy_lower, tidy_upper


def cleanse_customers(df: DataFrame) -> DataFrame:
    """Normalised email and country; rows without a key go."""
    return df.filter(F.col("customer_id").isNotNull()).withColumns(
        {"email": tidy_lower("email"), "country_code": tidy_upper("country_code")}
    )


def cleanse_transactions(df: DataFrame) -> DataFrame:
    """Money to two decimals, calendar columns; rows without a key or a positive amount go.

    The amount is tested after rounding (0.004 becomes 0.00 and goes). A NULL
    date stays.
    """
    day = to_day("txn_date")
    return (
        df.filter(F.col("transaction_id").isNotNull())
        .withColumns({"amount": to_money("amount"), "txn_date": day, "txn_year": F.year(day), "txn_month": F.month(day)})
        .filter(F.col("amount") > 0)
    )


def cleanse_products(df: DataFrame) -> DataFrame:
    """Normalised category, price to two decimals; rows without a key go."""
    return df.filter(F.col("product_id").isNotNull()).withColumns(
        {"category": tidy_lower("category"), "price": to_money("price")}
    )


RULES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": cleanse_customers,
    "transactions": cleanse_transactions,
    "products": cleanse_products,
}


def cleanse(df: DataFrame, table: str, run_ts: RunTime = None) -> DataFrame:
    """Apply the rules of ``table`` (none for an unknown name) and stamp the time."""
    rules = RULES.get(table, lambda frame: frame)
    return rules(df).withColumn("_silver_processed_at", run_time(run_ts))
