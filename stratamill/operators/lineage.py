"""Lineage columns stamped on every ingested row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.functions.days import RunTime, run_time


def stamp(df: DataFrame, source: str, cloud: str, layer: str = "bronze", run_ts: RunTime = None) -> DataFrame:
    """Add where the rows came from, and when they were ingested."""
    moment = run_time(run_ts)
    return df.withColumns(
        {
            "_source": F.lit(source),
            "_layer": F.lit(layer),
            "_cloud": F.lit(cloud),
            "_ingested_at": moment,
            "_date_part": F.to_date(moment),
        }
    )
