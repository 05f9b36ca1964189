"""Every query, as a function of a session and a directory of driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.catalogue import feeds
from stratamill.contracts import CLOUDS, CUSTOMERS, PRODUCTS, TRANSACTIONS
from stratamill.operators.combine import conform, distinct_values, union_positional, union_sources
from stratamill.operators.dedup import latest_per_key
from stratamill.operators.enrich import enrich
from stratamill.operators.layout import cluster, compact
from stratamill.operators.lineage import stamp
from stratamill.operators.quality import conservation, freshness, parity, repeated_values, unique
from stratamill.operators.upsert import upsert
from stratamill.plans import checks, gold, marts
from stratamill.plans.silver import silver_table
from stratamill.sinks.written import written_once
from stratamill.sources.files import read_files

# What each source leaves out of its feed.
ABSENT = {"aws": "status", "azure": "txn_date", "gcp": "feed_supplier"}


def _run_ts():
    return feeds.ntz(feeds.RUN_TS)


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare across engines."""
    return df.select(
        *[F.col(name).cast("double").alias(name) if kind.startswith("decimal") else name for name, kind in df.dtypes]
    )


def bronze_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_files(spark, f"{sf_dir}/lineitem.parquet", "parquet")
    return stamp(lines, "feed/lineitem", "aws", run_ts=_run_ts())


def bronze_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.raw_transactions(spark, sf_dir)
    delivered = {cloud: raw.filter(F.col("_cloud") == cloud).drop(ABSENT[cloud]) for cloud in CLOUDS}
    delivered["aws"] = delivered["aws"].withColumn("product_id", F.col("product_id").cast("bigint"))
    return union_sources(conform(frame, TRANSACTIONS) for frame in delivered.values())


def clouds_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(feeds.raw_lineage(spark, sf_dir), "_cloud")


def ids_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = feeds.raw_customers(spark, sf_dir).select("customer_id", "email")
    products = feeds.raw_products(spark, sf_dir).select("product_id", "category")
    return union_positional([customers, products])


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(feeds.raw_transactions(spark, sf_dir), "transaction_id", tie_break=feeds.TIE_BREAK)


def dedup_latest_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(feeds.raw_transactions(spark, sf_dir), "transaction_id")


def _silver_of(raw: DataFrame) -> DataFrame:
    return silver_table(raw, TRANSACTIONS, tie_break=feeds.TIE_BREAK, run_ts=_run_ts())


def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_of(feeds.raw_transactions(spark, sf_dir))


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_table(feeds.raw_customers(spark, sf_dir), CUSTOMERS, run_ts=_run_ts())


def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_table(feeds.raw_products(spark, sf_dir), PRODUCTS, run_ts=_run_ts())


def _table_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw = feeds.raw_transactions(spark, sf_dir)
    is_batch = F.col("_ingested_at") >= feeds.ntz(feeds.BATCH_CUTOFF)
    return _silver_of(raw.filter(~is_batch)), _silver_of(raw.filter(is_batch))


def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    so_far, batch = _table_and_batch(spark, sf_dir)
    return upsert(so_far, batch, "transaction_id")


def silver_upsert_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    so_far, batch = _table_and_batch(spark, sf_dir)
    return upsert(batch, so_far, "transaction_id", order_by="_ingested_at")


def enriched_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich(silver_transactions(spark, sf_dir), silver_customers(spark, sf_dir), silver_products(spark, sf_dir))
    return joined.select(
        "transaction_id", "customer_id", "product_id", "amount", "txn_date", "status", "country_code", "category"
    )


def _daily_revenue(silver: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, products = silver_customers(spark, sf_dir), silver_products(spark, sf_dir)
    return gold.daily_revenue(silver, customers, products, run_ts=_run_ts())


def _customer_rfm(silver: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.customer_rfm(silver, silver_customers(spark, sf_dir), as_of=feeds.AS_OF, run_ts=_run_ts())


def _product_performance(silver: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.product_performance(silver, silver_products(spark, sf_dir), run_ts=_run_ts())


def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_revenue(silver_transactions(spark, sf_dir), spark, sf_dir)


def customer_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_rfm(silver_transactions(spark, sf_dir), spark, sf_dir)


def product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _product_performance(silver_transactions(spark, sf_dir), spark, sf_dir)


def units_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_transactions(spark, sf_dir)
    return conservation(_product_performance(silver, spark, sf_dir), "units_sold", silver)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.stg_transactions(silver_transactions(spark, sf_dir))


def stg_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_numbers(_staged(spark, sf_dir))


def _mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_revenue_by_cloud(_staged(spark, sf_dir), run_ts=_run_ts())


def mart_revenue_by_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_numbers(_mart(spark, sf_dir))


def bi_top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_categories(daily_revenue(spark, sf_dir), as_of=feeds.AS_OF)


def bi_churned_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.churned_by_country(customer_rfm(spark, sf_dir))


def dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = written_once(silver_transactions(spark, sf_dir))
    staged = marts.stg_transactions(silver)
    return union_sources(
        [
            checks.staging_checks(staged),
            checks.mart_checks(marts.mart_revenue_by_cloud(staged)),
            checks.daily_checks(_daily_revenue(silver, spark, sf_dir)),
            checks.rfm_checks(_customer_rfm(silver, spark, sf_dir)),
        ]
    )


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.raw_transactions(spark, sf_dir)
    return union_sources(
        [unique(raw, "raw_transactions", "transaction_id"), checks.staging_key_check(_staged(spark, sf_dir))]
    )


def dq_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_values(feeds.raw_lineage(spark, sf_dir), "transaction_id")


def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.raw_lineage(spark, sf_dir)
    events = feeds.table(spark, sf_dir, "events")
    return union_sources(
        [
            freshness(events, "events", "ts", feeds.ntz(feeds.EVENTS_AS_OF)),
            freshness(raw, "raw_transactions", "_ingested_at", feeds.ntz(feeds.LINES_AS_OF)),
        ]
    )


def dq_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.raw_lineage(spark, sf_dir)
    return parity(raw, "raw_transactions", CLOUDS)


def dq_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.transaction_contract_checks(feeds.raw_transactions(spark, sf_dir))


def layout_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.table(spark, sf_dir, "lineitem")
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    keyed = lines.withColumn("product_id", F.col("l_partkey").cast("string"))
    return cluster(keyed, ["product_id", "l_shipdate"], spread=place)


def layout_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact(feeds.table(spark, sf_dir, "orders"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        bronze_stamp,
        bronze_union,
        clouds_present,
        ids_by_position,
        dedup_latest,
        dedup_latest_default,
        silver_transactions,
        silver_customers,
        silver_products,
        silver_upsert,
        silver_upsert_late,
        enriched_transactions,
        daily_revenue,
        customer_rfm,
        product_performance,
        units_conservation,
        stg_transactions,
        mart_revenue_by_cloud,
        bi_top_categories,
        bi_churned_by_country,
        dq_profile,
        dq_unique,
        dq_repeated_keys,
        dq_freshness,
        dq_parity,
        dq_contract,
        layout_roundtrip,
        layout_compacted,
    )
}
