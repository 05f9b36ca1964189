"""Staging view, revenue mart and BI reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamill.functions.days import AsOf, RunTime, as_of_day, run_time
from stratamill.functions.money import from_cents, percent_of, to_cents
from stratamill.functions.text import tidy_lower

COMPLETED = "completed"
REPORT_DAYS = 30


def is_staged() -> Column:
    """Whether a Silver transaction is valid: an amount that the exact decimal cannot hold is not."""
    amount = F.col("amount").try_cast("decimal(18,2)")
    return F.col("transaction_id").isNotNull() & (amount > 0) & F.col("txn_date").isNotNull()


def stg_transactions(silver: DataFrame) -> DataFrame:
    """Valid Silver transactions under reporting names, amounts as exact decimals."""
    valid = silver.filter(is_staged()).withColumn("amount", F.col("amount").try_cast("decimal(18,2)"))
    return valid.select(
        "transaction_id",
        "customer_id",
        "product_id",
        "amount",
        F.col("txn_date").cast("date").alias("txn_date"),
        "txn_year",
        "txn_month",
        tidy_lower("status").alias("status"),
        F.col("_cloud").alias("source_cloud"),
        F.col("_ingested_at").alias("ingested_at"),
    )


def mart_revenue_by_cloud(staged: DataFrame, *, run_ts: RunTime = None) -> DataFrame:
    """Revenue and completion per source and month, newest month first.

    Both distinct counts are kept although Silver has unique transaction ids:
    the staging view may be read over rows that were not deduplicated.
    """
    completed = F.when(F.col("status") == COMPLETED, F.col("amount")).otherwise(F.lit(0).cast("decimal(18,2)"))
    grouped = staged.groupBy("source_cloud", "txn_year", "txn_month").agg(
        F.countDistinct("transaction_id").alias("total_transactions"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.count("amount").alias("priced"),
        F.sum("amount").alias("total_revenue"),
        F.sum(completed).alias("completed_revenue"),
    )
    mart = grouped.select(
        "source_cloud",
        "txn_year",
        "txn_month",
        "total_transactions",
        "unique_customers",
        "total_revenue",
        F.try_divide(F.col("total_revenue").cast("double"), F.col("priced").cast("double")).alias("avg_order_value"),
        "completed_revenue",
        percent_of(F.col("completed_revenue"), F.col("total_revenue")).alias("completion_rate_pct"),
        run_time(run_ts).alias("dbt_updated_at"),
    )
    return mart.orderBy(F.desc("txn_year"), F.desc("txn_month"), F.asc_nulls_last("source_cloud"))


def top_categories(daily: DataFrame, *, as_of: AsOf = None, days: int = REPORT_DAYS) -> DataFrame:
    """Categories by revenue over the last ``days`` days, best first."""
    recent = daily.filter(F.col("txn_date") >= F.date_sub(as_of_day(as_of), days))
    revenue = recent.groupBy("category").agg(from_cents(F.sum(to_cents("total_revenue"))).alias("revenue"))
    return revenue.orderBy(F.desc("revenue"))


def churned_by_country(rfm: DataFrame) -> DataFrame:
    """Number of churned customers per country, most first."""
    churned = rfm.filter(F.col("rfm_segment") == "churned")
    return churned.groupBy("country_code").agg(F.count(F.lit(1)).alias("churned_customers")).orderBy(
        F.desc("churned_customers")
    )
