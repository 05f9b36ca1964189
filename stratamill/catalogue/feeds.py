"""The driver tables as Bronze feeds of the domain.

Line items are the transactions, customers and parts the dimensions. The source
data is clean, so dirt is put in by rule: missing ids, malformed and negative
amounts, missing dates, customers no dimension knows, padded text. Line item
keys repeat, which gives the deduplication real work.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(2001, 8, 1)
# Batches ingested from here on are "today's"; earlier ones are "the table so far".
BATCH_CUTOFF = "2001-01-01"
TIE_BREAK = ("feed_part", "feed_supplier")
EVENTS_AS_OF = "2024-01-31 12:00:00"
LINES_AS_OF = "2001-11-04 08:00:00"
RUN_TS = "2024-01-01 03:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    """A timestamp without time zone."""
    return F.to_timestamp_ntz(F.lit(text))


def _unless(bad: Column, value: Column) -> Column:
    return F.when(~bad, value)


def _cloud(supplier: Column) -> Column:
    place = supplier % 3
    return F.when(place == 0, "aws").when(place == 1, "azure").otherwise("gcp")


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as delivered: text ids and amounts, with lineage."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint") % 100_000
    signed = F.concat(
        F.when(_every("l_orderkey", 97) & (cents > 0), "-").otherwise(""),
        F.call_function("div", cents, F.lit(100)).cast("string"),
        F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", " Completed ").when(F.col("o_orderstatus") == "O", "PENDING").otherwise("failed")
    )
    customer = F.when(_every("l_orderkey", 79), F.concat(F.lit("guest-"), F.col("o_custkey").cast("string"))).otherwise(
        F.col("o_custkey").cast("string")
    )
    return lines.join(orders, "l_orderkey").select(
        _unless(_every("l_orderkey", 101), F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))).alias("transaction_id"),
        _unless(_every("l_orderkey", 83), customer).alias("customer_id"),
        _unless(_every("l_orderkey", 89), F.col("l_partkey").cast("string")).alias("product_id"),
        F.when(_every("l_partkey", 53), "N/A").otherwise(signed).alias("amount"),
        _unless(_every("l_suppkey", 61), F.to_date("o_orderdate")).alias("txn_date"),
        status.alias("status"),
        F.col("l_partkey").alias("feed_part"),
        F.col("l_suppkey").alias("feed_supplier"),
        F.lit("lineitem").alias("_source"),
        F.lit("bronze").alias("_layer"),
        _cloud(F.col("l_suppkey")).alias("_cloud"),
        F.col("l_shipdate").alias("_ingested_at"),
        F.to_date("l_shipdate").alias("_date_part"),
    )


def raw_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and lineage of the transactions: the line items alone have them, each with its order."""
    return table(spark, sf_dir, "lineitem").select(
        _unless(_every("l_orderkey", 101), F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))).alias("transaction_id"),
        _cloud(F.col("l_suppkey")).alias("_cloud"),
        F.col("l_shipdate").alias("_ingested_at"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as delivered."""
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return (
        table(spark, sf_dir, "customer")
        .join(nations, "c_nationkey")
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            _unless(_every("c_custkey", 71), F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))).alias("country_code"),
            F.concat(F.lit(" "), F.upper("c_name"), F.lit("@EXAMPLE.COM ")).alias("email"),
            ntz("2001-08-01 00:00:00").alias("_ingested_at"),
        )
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as delivered."""
    return table(spark, sf_dir, "part").select(
        _unless(_every("p_partkey", 67), F.col("p_partkey").cast("string")).alias("product_id"),
        F.concat(F.lit(" "), F.col("p_type")).alias("category"),
        F.col("p_retailprice").cast("decimal(18,2)").cast("string").alias("price"),
        ntz("2001-08-01 00:00:00").alias("_ingested_at"),
    )
