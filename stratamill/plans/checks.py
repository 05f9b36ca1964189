"""The checks each model must pass, and the gate that enforces them."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.contracts import CLOUDS, TRANSACTIONS
from stratamill.functions.days import RunTime
from stratamill.operators.combine import union_sources
from stratamill.operators.quality import (
    Observed,
    RowRule,
    conservation,
    contract_rules,
    freshness,
    in_range,
    not_null,
    one_of,
    profile,
    report,
    unique,
)
from stratamill.plans.gold import CHURNED, SEGMENT_UP_TO_DAYS
from stratamill.plans.marts import is_staged

logger = logging.getLogger(__name__)

HOUR = 3_600_000_000
WARN_AGE, ERROR_AGE = 6 * HOUR, 24 * HOUR



class QualityError(RuntimeError):
    """A model broke its checks and was not published."""


def mart_rules() -> list[RowRule]:
    return [in_range("total_revenue", low=0), in_range("completion_rate_pct", low=0, high=100)]


def daily_rules() -> list[RowRule]:
    return [in_range("total_revenue", low=0)]


def rfm_rules() -> list[RowRule]:
    return [one_of("rfm_segment", (*SEGMENT_UP_TO_DAYS, CHURNED))]


def observed_transactions(batch: DataFrame, clouds: Sequence[str]) -> Observed:
    """Incoming Silver transactions, checked as they are written: the staging rules on the rows
    that will be staged, the declared types on all; and ``newest``, when the last one was ingested."""
    staged = [not_null("transaction_id"), not_null("customer_id"), in_range("amount", low=0), one_of("_cloud", clouds)]
    names = {"_cloud": "source_cloud"}
    rules = [RowRule(r.check, names.get(r.column, r.column), is_staged() & r.broken) for r in staged]
    rules += contract_rules(batch, TRANSACTIONS.columns)
    return Observed(batch, "stg_transactions", rules, newest=F.max(F.unix_micros("_ingested_at")))


def freshness_of(spark: SparkSession, newest: int | None, now: int) -> DataFrame:
    """Whether the newest row, ingested at ``newest`` (microseconds), is less than a day old at ``now``."""
    age = None if newest is None else now - newest
    if age is not None and WARN_AGE < age <= ERROR_AGE:
        logger.warning("the newest transaction was ingested %.1f hours ago", age / HOUR)
    stale = age is None or age > ERROR_AGE
    return report(spark, "silver_transactions", [("freshness", "_ingested_at", int(stale))])


def conservation_of(observed: Observed, column: str, n_rows: int) -> DataFrame:
    """An observed model's counts, totalled under ``total``, add up to the rows it was built from."""
    total = observed.total("total") or 0
    lines = [("conservation", column, abs(total - n_rows))]
    return report(observed.rows.sparkSession, observed.model, lines)


def staging_checks(staged: DataFrame, clouds: Sequence[str] = CLOUDS) -> DataFrame:
    """Row rules of the staged transactions, from the sources ``clouds``."""
    return profile(
        staged,
        "stg_transactions",
        [
            not_null("transaction_id"),
            not_null("customer_id"),
            in_range("amount", low=0),
            one_of("source_cloud", clouds),
        ],
    )


def staging_key_check(staged: DataFrame) -> DataFrame:
    """The transaction id is unique."""
    return unique(staged, "stg_transactions", "transaction_id")


def mart_checks(mart: DataFrame) -> DataFrame:
    """Row rules of the revenue mart."""
    return profile(mart, "mart_revenue_by_cloud", mart_rules())


def daily_checks(daily: DataFrame) -> DataFrame:
    """Row rules of the daily revenue model."""
    return profile(daily, "daily_revenue", daily_rules())


def rfm_checks(rfm: DataFrame) -> DataFrame:
    """Row rules of the customer model."""
    return profile(rfm, "customer_rfm", rfm_rules())


def transaction_contract_checks(raw: DataFrame) -> DataFrame:
    """Raw transaction values that do not fit their declared type."""
    return profile(raw, "transactions", contract_rules(raw, TRANSACTIONS.columns))


def silver_contract_checks(silver: DataFrame) -> DataFrame:
    """Columns of the published transactions that are missing or not of their declared type."""
    return profile(silver, "silver_transactions", contract_rules(silver, TRANSACTIONS.columns))


def freshness_check(df: DataFrame, model: str, as_of: RunTime = None) -> DataFrame:
    """The newest row is less than a day old; one violation if not."""
    age = freshness(df, model, "_ingested_at", as_of)
    stale = F.col("status") == "error"
    return age.select(
        "model",
        F.lit("freshness").alias("check"),
        F.col("loaded_at").alias("column_name"),
        stale.cast("bigint").alias("violations"),
        F.when(stale, "fail").otherwise("pass").alias("status"),
    )


def conservation_check(performance: DataFrame, silver: DataFrame) -> DataFrame:
    """Units sold add up to the transactions; violations are the difference."""
    return conservation(performance, "units_sold", silver).select(
        F.lit("product_performance").alias("model"),
        F.lit("conservation").alias("check"),
        F.lit("units_sold").alias("column_name"),
        F.abs(F.col("total_units") - F.col("n_rows")).alias("violations"),
        "status",
    )


# Rules that business data may break: they are reported, and block nothing.
WARN_ONLY = frozenset({("stg_transactions", "not_null", "customer_id")})


def enforce(*checks: DataFrame) -> list[str]:
    """Run checks; raise :class:`QualityError` naming those that failed, but for those that only warn.

    A check frame has one row per rule, so what is collected does not grow
    with the data.
    """
    results = union_sources(checks).collect()
    lines = [f"{r.model}.{r.column_name} {r.check}: {r.violations} violations" for r in results]
    broken = [(line, (r.model, r.check, r.column_name)) for line, r in zip(lines, results, strict=True) if r.status != "pass"]
    failed = [line for line, rule in broken if rule not in WARN_ONLY]
    for line, rule in broken:
        if rule in WARN_ONLY:
            logger.warning("%s", line)
    if failed:
        raise QualityError("; ".join(failed))
    logger.info("%d checks passed", len(lines))
    return lines
