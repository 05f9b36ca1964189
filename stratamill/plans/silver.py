"""Silver: one clean row per key from all sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stratamill.contracts import TableContract
from stratamill.functions.days import RunTime
from stratamill.operators.cleanse import cleanse
from stratamill.operators.combine import conform
from stratamill.operators.dedup import latest_per_key


def silver_table(
    bronze: DataFrame,
    contract: TableContract,
    *,
    tie_break: Sequence[str] | None = None,
    run_ts: RunTime = None,
) -> DataFrame:
    """Conform, keep the latest row per key, cleanse.

    The order matters: when the latest row of a key is invalid, the key is
    dropped; an older valid row does not come back.
    """
    latest = latest_per_key(conform(bronze, contract), contract.key, tie_break=tie_break)
    return cleanse(latest, contract.name, run_ts)
