"""Gold models.

Each model first aggregates the transactions by what it will join on, and joins
the dimension to that much smaller result. The dimension's equal rows are counted
before the join, and the totals multiplied by that number, so the outcome is
the same as joining every row first, also when a dimension repeats a key or a key
finds no match; but no task holds the aggregated rows a second time. The join moves
aggregated rows only, and a customer or product with a third of all rows has
been folded on the map side before any shuffle.

The first aggregation of a model is a function of its own, so that its result can be
stored by month and taken up again (:mod:`stratamill.plans.refresh`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamill.functions.days import AsOf, RunTime, as_of_day, run_time, within_days
from stratamill.functions.money import from_cents, money_per, to_cents
from stratamill.operators.enrich import REPEATS, with_counted_dimension, with_dimension

HIGH_VALUE_ABOVE = 500
HORIZON_DAYS = (30, 60, 90)
# Longest recency of each segment; beyond the last one a customer counts as churned.
SEGMENT_UP_TO_DAYS = {"champion": 30, "loyal": 60, "at_risk": 90}
CHURNED = "churned"


def daily_revenue(
    transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    *,
    high_value_above: float = HIGH_VALUE_ABOVE,
    run_ts: RunTime = None,
) -> DataFrame:
    """Revenue per day, category and country."""
    return daily_from(daily_part(transactions, customers, products, high_value_above=high_value_above), run_ts=run_ts)


def daily_part(
    transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    *,
    high_value_above: float = HIGH_VALUE_ABOVE,
    by: Sequence[str] = (),
) -> DataFrame:
    """Exact totals per day, category and country.

    With the month in ``by``, which the day implies, the totals of one month come from its transactions alone.
    """
    per_customer = (
        with_dimension(transactions, products, "product_id", ["category"])
        .groupBy(*by, "txn_date", "category", "customer_id")
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            F.count("amount").alias("priced"),
            F.sum(to_cents("amount")).alias("cents"),
            F.count_if(F.col("amount") > high_value_above).alias("high_value_orders"),
        )
    )
    return (
        with_counted_dimension(per_customer, customers, "customer_id", ["country_code"])
        .groupBy(*by, "txn_date", "category", "country_code")
        .agg(
            *[F.sum(F.col(name) * F.col(REPEATS)).alias(name) for name in ("total_transactions", "priced", "cents")],
            # A customer has one row in a group.
            F.count("customer_id").alias("unique_customers"),
            F.sum(F.col("high_value_orders") * F.col(REPEATS)).alias("high_value_orders"),
        )
    )


def daily_from(part: DataFrame, *, run_ts: RunTime = None) -> DataFrame:
    """The model of the totals."""
    revenue = from_cents("cents")
    return part.select(
        "txn_date",
        "category",
        "country_code",
        "total_transactions",
        revenue.alias("total_revenue"),
        F.try_divide(revenue, F.col("priced").cast("double")).alias("avg_order_value"),
        "unique_customers",
        "high_value_orders",
        money_per(F.col("cents"), F.col("unique_customers")).alias("revenue_per_customer"),
        run_time(run_ts).alias("_gold_built_at"),
    )


def customer_rfm(
    transactions: DataFrame, customers: DataFrame, *, as_of: AsOf = None, run_ts: RunTime = None
) -> DataFrame:
    """Spend, recency and segment per customer as of one day."""
    return _rfm(transactions, F.count("transaction_id"), to_cents("amount"), customers, as_of, run_ts)


def customer_days(transactions: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Orders and exact spend per customer and day; what the horizons of any day can be taken from."""
    return transactions.groupBy(*by, "customer_id", "txn_date").agg(
        F.count("transaction_id").alias("total_orders"), F.sum(to_cents("amount")).alias("cents")
    )


def rfm_from(days: DataFrame, customers: DataFrame, *, as_of: AsOf = None, run_ts: RunTime = None) -> DataFrame:
    """The model of the customers' days."""
    return _rfm(days, F.sum("total_orders"), F.col("cents"), customers, as_of, run_ts)


def _rfm(
    rows: DataFrame, orders: Column, cents: Column, customers: DataFrame, as_of: AsOf, run_ts: RunTime
) -> DataFrame:
    today = as_of_day(as_of)
    horizons = [f"spend_{days}d" for days in HORIZON_DAYS]
    per_customer = rows.groupBy("customer_id").agg(
        orders.alias("total_orders"),
        F.sum(cents).alias("lifetime_spend"),
        F.max("txn_date").alias("last_order_date"),
        F.min("txn_date").alias("first_order_date"),
        *[
            F.sum(F.when(within_days("txn_date", days, today), cents)).alias(name)
            for name, days in zip(horizons, HORIZON_DAYS, strict=True)
        ],
    )
    per_group = with_counted_dimension(per_customer, customers, "customer_id", ["country_code"]).withColumns(
        {name: F.col(name) * F.col(REPEATS) for name in ("total_orders", "lifetime_spend", *horizons)}
    )
    recency = F.datediff(today, "last_order_date")
    segment = F
    for label, days in SEGMENT_UP_TO_DAYS.items():
        segment = segment.when(recency <= days, label)
    return per_group.select(
        "customer_id",
        "country_code",
        "total_orders",
        from_cents("lifetime_spend").alias("lifetime_spend"),
        "last_order_date",
        "first_order_date",
        *[from_cents(name).alias(name) for name in horizons],
        recency.alias("recency_days"),
        segment.otherwise(CHURNED).alias("rfm_segment"),
        run_time(run_ts).alias("_gold_built_at"),
    )


def product_performance(transactions: DataFrame, products: DataFrame, *, run_ts: RunTime = None) -> DataFrame:
    """Units, revenue and buyers per product and month."""
    return performance_from(product_months(transactions), products, run_ts=run_ts)


def product_months(transactions: DataFrame) -> DataFrame:
    """Units, exact revenue and buyers per product and month, without the products' table."""
    return transactions.groupBy("product_id", "txn_year", "txn_month").agg(
        F.count("transaction_id").alias("units_sold"),
        F.count("amount").alias("priced"),
        F.sum(to_cents("amount")).alias("cents"),
        F.countDistinct("customer_id").alias("unique_buyers"),
    )


def performance_from(months: DataFrame, products: DataFrame, *, run_ts: RunTime = None) -> DataFrame:
    """The model of the products' months."""
    per_group = with_counted_dimension(months, products, "product_id", ["category"]).withColumns(
        {name: F.col(name) * F.col(REPEATS) for name in ("units_sold", "priced", "cents")}
    )
    revenue = from_cents("cents")
    return per_group.select(
        "product_id",
        "category",
        "txn_year",
        "txn_month",
        "units_sold",
        revenue.alias("gross_revenue"),
        F.try_divide(revenue, F.col("priced").cast("double")).alias("avg_selling_price"),
        "unique_buyers",
        run_time(run_ts).alias("_gold_built_at"),
    )
