"""The same queries in SQL for DuckDB, written from the definitions, not from the Spark code.

Money is summed as decimals and reported as double. Rounded ratios are computed
half up on whole cents, because engines disagree on rounding doubles.
"""

from __future__ import annotations

from stratamill.catalogue.feeds import AS_OF, BATCH_CUTOFF, EVENTS_AS_OF, LINES_AS_OF, RUN_TS

RUN = f"TIMESTAMP '{RUN_TS}'"
TODAY = f"DATE '{AS_OF}'"

RAW_TRANSACTIONS = """
raw_transactions AS (
  SELECT
    CASE WHEN l_orderkey % 101 <> 0 THEN concat(l_orderkey, '-', l_linenumber) END AS transaction_id,
    CASE WHEN l_orderkey % 83 = 0 THEN NULL
         WHEN l_orderkey % 79 = 0 THEN concat('guest-', o_custkey)
         ELSE CAST(o_custkey AS varchar) END AS customer_id,
    CASE WHEN l_orderkey % 89 <> 0 THEN CAST(l_partkey AS varchar) END AS product_id,
    CASE WHEN l_partkey % 53 = 0 THEN 'N/A'
         ELSE CAST(CAST((CAST(l_extendedprice AS decimal(18,2)) % 1000)
              * (CASE WHEN l_orderkey % 97 = 0 THEN -1 ELSE 1 END) AS decimal(18,2)) AS varchar) END AS amount,
    CASE WHEN l_suppkey % 61 <> 0 THEN CAST(o_orderdate AS date) END AS txn_date,
    CASE o_orderstatus WHEN 'F' THEN ' Completed ' WHEN 'O' THEN 'PENDING' ELSE 'failed' END AS status,
    l_partkey AS feed_part,
    l_suppkey AS feed_supplier,
    'lineitem' AS _source,
    'bronze' AS _layer,
    CASE l_suppkey % 3 WHEN 0 THEN 'aws' WHEN 1 THEN 'azure' ELSE 'gcp' END AS _cloud,
    l_shipdate AS _ingested_at,
    CAST(l_shipdate AS date) AS _date_part
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

NEWEST_FIRST = (
    "row_number() OVER (PARTITION BY transaction_id"
    " ORDER BY _ingested_at DESC NULLS LAST, feed_part DESC, feed_supplier DESC) = 1"
)


# All other columns in turn, greatest first.
EVERY_COLUMN = ", ".join(
    f"{name} DESC NULLS LAST"
    for name in (
        "customer_id", "product_id", "amount", "txn_date", "status", "feed_part", "feed_supplier", "_source", "_layer",
        "_cloud", "_date_part",
    )
)


def _silver_transactions(name: str, condition: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT transaction_id, customer_id, product_id, round(TRY_CAST(amount AS double), 2) AS amount, txn_date,
         status, feed_part, feed_supplier, _source, _layer, _cloud, _ingested_at, _date_part,
         CAST(year(txn_date) AS integer) AS txn_year, CAST(month(txn_date) AS integer) AS txn_month,
         {RUN} AS _silver_processed_at
  FROM (SELECT * FROM raw_transactions WHERE {condition} QUALIFY {NEWEST_FIRST}) latest
  WHERE transaction_id IS NOT NULL AND round(TRY_CAST(amount AS double), 2) > 0
)"""


SILVER_TRANSACTIONS = RAW_TRANSACTIONS + "," + _silver_transactions("silver_transactions")

SILVER_CUSTOMERS = f"""
silver_customers AS (
  SELECT CAST(c_custkey AS varchar) AS customer_id,
         CASE WHEN c_custkey % 71 <> 0 THEN upper(n_name) END AS country_code,
         concat(lower(c_name), '@example.com') AS email,
         TIMESTAMP '2001-08-01 00:00:00' AS _ingested_at,
         {RUN} AS _silver_processed_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

SILVER_PRODUCTS = f"""
silver_products AS (
  SELECT CAST(p_partkey AS varchar) AS product_id, lower(p_type) AS category,
         CAST(CAST(p_retailprice AS decimal(18,2)) AS double) AS price,
         TIMESTAMP '2001-08-01 00:00:00' AS _ingested_at,
         {RUN} AS _silver_processed_at
  FROM part WHERE p_partkey % 67 <> 0
)"""

ENRICHED = f"""{SILVER_TRANSACTIONS},{SILVER_CUSTOMERS},{SILVER_PRODUCTS},
enriched AS (
  SELECT t.*, CAST(t.amount AS decimal(18,2)) AS money, c.country_code, p.category
  FROM silver_transactions t
  LEFT JOIN silver_customers c ON t.customer_id = c.customer_id
  LEFT JOIN silver_products p ON t.product_id = p.product_id
)"""

DAILY = f"""{ENRICHED},
daily AS (
  SELECT txn_date, category, country_code,
         count(transaction_id) AS total_transactions,
         CAST(sum(money) AS double) AS total_revenue,
         CAST(sum(money) AS double) / count(money) AS avg_order_value,
         count(DISTINCT customer_id) AS unique_customers,
         CAST(sum(CASE WHEN money > 500 THEN 1 ELSE 0 END) AS bigint) AS high_value_orders,
         CASE WHEN count(DISTINCT customer_id) > 0 THEN
           CAST((2 * CAST(sum(money) * 100 AS bigint) + count(DISTINCT customer_id))
                // (2 * count(DISTINCT customer_id)) AS double) / 100 END AS revenue_per_customer,
         {RUN} AS _gold_built_at
  FROM enriched GROUP BY txn_date, category, country_code
)"""


def _horizon(days: int) -> str:
    return (
        f"CAST(sum(CASE WHEN date_diff('day', txn_date, {TODAY}) <= {days} THEN money END) AS double) AS spend_{days}d"
    )


RFM = f"""{ENRICHED},
rfm_base AS (
  SELECT customer_id, country_code, count(transaction_id) AS total_orders,
         CAST(sum(money) AS double) AS lifetime_spend,
         max(txn_date) AS last_order_date, min(txn_date) AS first_order_date,
         {_horizon(30)}, {_horizon(60)}, {_horizon(90)},
         CAST(date_diff('day', max(txn_date), {TODAY}) AS integer) AS recency_days
  FROM enriched GROUP BY customer_id, country_code
),
rfm AS (
  SELECT *, CASE WHEN recency_days <= 30 THEN 'champion' WHEN recency_days <= 60 THEN 'loyal'
                 WHEN recency_days <= 90 THEN 'at_risk' ELSE 'churned' END AS rfm_segment,
         {RUN} AS _gold_built_at
  FROM rfm_base
)"""

PERFORMANCE = f"""{ENRICHED},
performance AS (
  SELECT product_id, category, txn_year, txn_month, count(transaction_id) AS units_sold,
         CAST(sum(money) AS double) AS gross_revenue,
         CAST(sum(money) AS double) / count(money) AS avg_selling_price,
         count(DISTINCT customer_id) AS unique_buyers,
         {RUN} AS _gold_built_at
  FROM enriched GROUP BY product_id, category, txn_year, txn_month
)"""

STAGED_CTE = """
staged AS (
  SELECT transaction_id, customer_id, product_id, CAST(amount AS decimal(18,2)) AS amount, txn_date, txn_year,
         txn_month, lower(trim(status)) AS status, _cloud AS source_cloud, _ingested_at AS ingested_at
  FROM silver_transactions WHERE amount > 0 AND txn_date IS NOT NULL
)"""
STAGED = f"{SILVER_TRANSACTIONS},{STAGED_CTE}"

MART_CTE = f"""
mart AS (
  SELECT source_cloud, txn_year, txn_month, count(DISTINCT transaction_id) AS total_transactions,
         count(DISTINCT customer_id) AS unique_customers,
         CAST(sum(amount) AS double) AS total_revenue,
         CAST(sum(amount) AS double) / count(amount) AS avg_order_value,
         CAST(sum(CASE WHEN status = 'completed' THEN amount ELSE 0 END) AS double) AS completed_revenue,
         CAST((2 * CAST(sum(CASE WHEN status = 'completed' THEN amount ELSE 0 END) * 100 AS bigint) * 10000
               + CAST(sum(amount) * 100 AS bigint)) // (2 * CAST(sum(amount) * 100 AS bigint)) AS double) / 100
           AS completion_rate_pct,
         {RUN} AS dbt_updated_at
  FROM staged GROUP BY source_cloud, txn_year, txn_month
)"""


def _check_line(model: str, check: str, column: str, broken: str, relation: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{check}' AS \"check\", '{column}' AS column_name,"
        f" count(*) FILTER (WHERE {broken}) AS violations,"
        f" CASE WHEN count(*) FILTER (WHERE {broken}) = 0 THEN 'pass' ELSE 'fail' END AS status FROM {relation}"
    )


PROFILE_LINES = [
    ("stg_transactions", "not_null", "transaction_id", "transaction_id IS NULL", "staged"),
    ("stg_transactions", "not_null", "customer_id", "customer_id IS NULL", "staged"),
    ("stg_transactions", "accepted_range", "amount", "amount < 0", "staged"),
    ("stg_transactions", "accepted_values", "source_cloud", "source_cloud NOT IN ('aws','azure','gcp')", "staged"),
    ("mart_revenue_by_cloud", "accepted_range", "total_revenue", "total_revenue < 0", "mart"),
    (
        "mart_revenue_by_cloud",
        "accepted_range",
        "completion_rate_pct",
        "completion_rate_pct < 0 OR completion_rate_pct > 100",
        "mart",
    ),
    ("daily_revenue", "accepted_range", "total_revenue", "total_revenue < 0", "daily"),
    (
        "customer_rfm",
        "accepted_values",
        "rfm_segment",
        "rfm_segment NOT IN ('champion','loyal','at_risk','churned')",
        "rfm",
    ),
]

CONTRACT_LINES = [
    ("transactions", f"type_{kind}", name, f"{name} IS NOT NULL AND TRY_CAST({name} AS {sql}) IS NULL", "raw_transactions")
    for name, kind, sql in (
        ("transaction_id", "string", "varchar"),
        ("customer_id", "string", "varchar"),
        ("product_id", "string", "varchar"),
        ("amount", "double", "double"),
        ("txn_date", "date", "date"),
        ("status", "string", "varchar"),
    )
]


def _unique_line(model: str, relation: str) -> str:
    repeated = (
        f"SELECT transaction_id FROM {relation} WHERE transaction_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    )
    return (
        f"SELECT '{model}' AS model, 'unique' AS \"check\", 'transaction_id' AS column_name, count(*) AS violations,"
        f" CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({repeated}) r"
    )


def _freshness_line(model: str, column: str, relation: str, as_of: str) -> str:
    return f"""
  SELECT '{model}' AS model, '{column}' AS loaded_at, newest, age_us,
         CASE WHEN age_us IS NULL OR age_us > 24 * 3600000000 THEN 'error'
              WHEN age_us > 6 * 3600000000 THEN 'warn' ELSE 'pass' END AS status
  FROM (SELECT max({column}) AS newest, date_diff('microsecond', max({column}), TIMESTAMP '{as_of}') AS age_us
        FROM {relation}) f"""


def _delivered(cloud: str, absent: str) -> str:
    columns = [
        "transaction_id", "customer_id", "product_id", "TRY_CAST(amount AS double) AS amount", "txn_date", "status",
        "feed_part", "feed_supplier", "_source", "_layer", "_cloud", "_ingested_at", "_date_part",
    ]
    listed = ", ".join(f"NULL AS {c}" if c == absent else c for c in columns)
    return f"SELECT {listed} FROM raw_transactions WHERE _cloud = '{cloud}'"


BATCHES = (
    RAW_TRANSACTIONS
    + ","
    + _silver_transactions("so_far", f"_ingested_at < TIMESTAMP '{BATCH_CUTOFF}'")
    + ","
    + _silver_transactions("batch", f"_ingested_at >= TIMESTAMP '{BATCH_CUTOFF}'")
)

ORACLE: dict[str, str] = {
    "bronze_stamp": f"""
SELECT *, 'feed/lineitem' AS _source, 'bronze' AS _layer, 'aws' AS _cloud, {RUN} AS _ingested_at,
       CAST({RUN} AS date) AS _date_part FROM lineitem""",
    "bronze_union": f"WITH {RAW_TRANSACTIONS} {_delivered('aws', 'status')} UNION ALL BY NAME"
    f" {_delivered('azure', 'txn_date')} UNION ALL BY NAME {_delivered('gcp', 'feed_supplier')}",
    "clouds_present": f"WITH {RAW_TRANSACTIONS} SELECT DISTINCT _cloud FROM raw_transactions",
    "ids_by_position": """
SELECT CAST(c_custkey AS varchar) AS customer_id, concat(' ', upper(c_name), '@EXAMPLE.COM ') AS email
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT CASE WHEN p_partkey % 67 <> 0 THEN CAST(p_partkey AS varchar) END, concat(' ', p_type) FROM part""",
    "dedup_latest": f"WITH {RAW_TRANSACTIONS} SELECT * FROM raw_transactions QUALIFY {NEWEST_FIRST}",
    "dedup_latest_default": f"""WITH {RAW_TRANSACTIONS} SELECT * FROM raw_transactions
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY _ingested_at DESC NULLS LAST, {EVERY_COLUMN}) = 1""",
    "silver_transactions": f"WITH {SILVER_TRANSACTIONS} SELECT * FROM silver_transactions",
    "silver_customers": f"WITH {SILVER_CUSTOMERS} SELECT * FROM silver_customers",
    "silver_products": f"WITH {SILVER_PRODUCTS} SELECT * FROM silver_products",
    "silver_upsert": f"""WITH {BATCHES}
SELECT * FROM batch UNION ALL
SELECT * FROM so_far s WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.transaction_id = s.transaction_id)""",
    "silver_upsert_late": f"""WITH {BATCHES}
SELECT * EXCLUDE (held) FROM (SELECT *, 1 AS held FROM batch UNION ALL SELECT *, 0 AS held FROM so_far) both_sides
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY _ingested_at DESC, held) = 1""",
    "enriched_transactions": f"""WITH {ENRICHED}
SELECT transaction_id, customer_id, product_id, amount, txn_date, status, country_code, category FROM enriched""",
    "daily_revenue": f"WITH {DAILY} SELECT * FROM daily",
    "customer_rfm": f"WITH {RFM} SELECT * FROM rfm",
    "product_performance": f"WITH {PERFORMANCE} SELECT * FROM performance",
    "units_conservation": f"""WITH {PERFORMANCE}
SELECT CAST(total_units AS bigint) AS total_units, n_rows,
       CASE WHEN total_units = n_rows THEN 'pass' ELSE 'fail' END AS status
FROM (SELECT sum(units_sold) AS total_units FROM performance), (SELECT count(*) AS n_rows FROM silver_transactions)""",
    "stg_transactions": f"WITH {STAGED} SELECT * REPLACE (CAST(amount AS double) AS amount) FROM staged",
    "mart_revenue_by_cloud": f"""WITH {STAGED},{MART_CTE}
SELECT * FROM mart ORDER BY txn_year DESC, txn_month DESC, source_cloud""",
    "bi_top_categories": f"""WITH {ENRICHED}
SELECT category, CAST(sum(money) AS double) AS revenue FROM enriched
WHERE txn_date >= {TODAY} - INTERVAL 30 DAY GROUP BY category ORDER BY revenue DESC NULLS LAST""",
    "bi_churned_by_country": f"""WITH {RFM}
SELECT country_code, count(*) AS churned_customers FROM rfm WHERE rfm_segment = 'churned'
GROUP BY country_code ORDER BY churned_customers DESC""",
    "dq_profile": "WITH "
    + ",".join([DAILY, RFM.removeprefix(ENRICHED).lstrip(","), STAGED_CTE, MART_CTE])
    + " UNION ALL ".join(_check_line(*line) for line in PROFILE_LINES),
    "dq_unique": f"WITH {STAGED} {_unique_line('raw_transactions', 'raw_transactions')}"
    f" UNION ALL {_unique_line('stg_transactions', 'staged')}",
    "dq_repeated_keys": f"""WITH {RAW_TRANSACTIONS}
SELECT transaction_id, count(*) AS n_rows FROM raw_transactions
WHERE transaction_id IS NOT NULL GROUP BY transaction_id HAVING count(*) > 1""",
    "dq_freshness": f"WITH {RAW_TRANSACTIONS} {_freshness_line('events', 'ts', 'events', EVENTS_AS_OF)}"
    f" UNION ALL {_freshness_line('raw_transactions', '_ingested_at', 'raw_transactions', LINES_AS_OF)}",
    "dq_parity": f"""WITH {RAW_TRANSACTIONS},
counts AS (SELECT _cloud, count(*) AS n FROM raw_transactions GROUP BY _cloud)
SELECT 'raw_transactions' AS model, min(n) AS least_rows, max(n) AS most_rows,
       CAST(max(n) - min(n) AS double) / CAST(max(n) AS double) AS gap,
       CASE WHEN CAST(max(n) - min(n) AS double) / CAST(max(n) AS double) <= 0.05 THEN 'pass' ELSE 'fail' END AS status
FROM counts""",
    "dq_contract": f"WITH {RAW_TRANSACTIONS} " + " UNION ALL ".join(_check_line(*line) for line in CONTRACT_LINES),
    "layout_roundtrip": "SELECT *, CAST(l_partkey AS varchar) AS product_id FROM lineitem",
    "layout_compacted": "SELECT * FROM orders",
}
