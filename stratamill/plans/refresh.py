"""Gold by change: stored partial aggregates, renewed only for the months that changed.

Beside the primary Gold models stand three published tables, each partitioned by month like the
Silver transactions: the exact totals of daily revenue, the customers' days and the
products' months. Their versions carry, as marks, the Silver versions they were made of. A
refresh compares the lists of that version and the present one:

* a month is touched if its directories or files differ: rows came, were corrected or moved
  to another month. A month that was only laid out anew is touched too; it then gives the
  same totals again;
* daily revenue holds dimension columns, so a product whose category or a customer whose
  country differs touches the months the key occurs in, which the other two tables tell.
  Only files of the dimension that differ are read.

Touched months are aggregated anew from all of their transactions and replace the
stored ones; the others stay as they are. The models are finished from the stored
totals, which are exact whole numbers, so the result is that of a full build.

What reaches the driver is lists of directories, and the months of changed keys. A job
that dies has published nothing of the table it was at; the next one does the same again.
Where the older list or a file it names is gone, all months are touched.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.contracts import CONTRACTS, CUSTOMERS, PRODUCTS, TRANSACTIONS
from stratamill.plans.gold import customer_days, daily_part, product_months
from stratamill.sinks.published import (
    NULL_PARTITION,
    current_version,
    directories_at,
    live_directories,
    live_marks,
    partition_of,
    publish,
    read_directories,
    read_published,
    stage,
)

logger = logging.getLogger(__name__)

MONTH = TRANSACTIONS.partition_by
DAILY, DAYS, MONTHS = "daily_totals", "customer_days", "product_months"


@dataclass(frozen=True)
class Silver:
    """One version of every Silver table."""

    spark: SparkSession
    base: str
    versions: Mapping[str, int]

    @classmethod
    def now(cls, spark: SparkSession, base: str) -> Silver:
        versions = {name: current_version(spark, f"{base}/{name}") for name in CONTRACTS}
        missing = [name for name, version in versions.items() if not version]
        if missing:
            raise FileNotFoundError(f"nothing published at {base} for {missing}")
        return cls(spark, base, versions)

    def entries(self, table: str, version: int | None = None) -> list[str] | None:
        return directories_at(self.spark, f"{self.base}/{table}", version or self.versions[table])

    def rows(self, table: str, entries: Sequence[str] | None = None) -> DataFrame:
        """Rows of some entries of a list, by default of all of this version."""
        live = self.entries(table)
        return read_directories(self.spark, f"{self.base}/{table}", live if entries is None else entries, like=live)

    def touched_months(self, before: int | None) -> set[str] | None:
        """Partitions of the transactions that differ between a version and this one; None if that cannot be told."""
        if before == self.versions[TRANSACTIONS.name]:
            return set()
        old = self.entries(TRANSACTIONS.name, before) if before else None
        if old is None:
            return None
        return {partition_of(e) for e in {*old} ^ {*self.entries(TRANSACTIONS.name)}}

    def changed_keys(self, table: str, column: str, before: int | None) -> DataFrame | None:
        """Keys of a dimension whose values of ``column`` differ between a version and this one.

        Values are compared with their number of rows, since a repeated key repeats facts.
        None if that cannot be told.
        """
        key, root = CONTRACTS[table].key, f"{self.base}/{table}"
        old, new = self.entries(table, before) if before else None, self.entries(table)
        if old is None:
            return None
        signed = []
        for entries, sign in ((sorted({*old} - {*new}), -1), (sorted({*new} - {*old}), 1)):
            if entries:
                try:
                    rows = read_directories(self.spark, root, entries, like=new)
                except AnalysisException as error:
                    if error.getCondition() == "PATH_NOT_FOUND":
                        return None
                    raise
                signed.append(rows.select(key, column, F.lit(sign).alias("_sign")))
        if not signed:
            return self.rows(table).select(key).limit(0)
        both = signed[0] if len(signed) == 1 else signed[0].unionByName(signed[1])
        differ = both.filter(F.col(key).isNotNull()).groupBy(key, column).agg(F.sum("_sign").alias("_more"))
        return differ.filter("_more <> 0").select(key).distinct()


def _months_of(part: DataFrame, keys: DataFrame, key: str) -> set[str]:
    """Partitions of a stored table in which some keys occur."""
    found = part.join(keys, key, "left_semi").select(*MONTH).distinct().collect()
    return {"".join(f"/{c}={NULL_PARTITION if row[c] is None else row[c]}" for c in MONTH) for row in found}


def _refresh(
    silver: Silver, root: str, touched: set[str] | None, part: Callable[[DataFrame], DataFrame]
) -> int:
    """Replace the touched months of one stored table, all of them for None; returns how many were made anew."""
    spark, made = silver.spark, []
    entries = silver.entries(TRANSACTIONS.name)
    wanted = entries if touched is None else [e for e in entries if partition_of(e) in touched]
    marks = {name: version for name, version in silver.versions.items()}
    if touched is not None and not touched and live_marks(spark, root) == marks:
        return 0
    if wanted:
        made = stage(part(silver.rows(TRANSACTIONS.name, wanted)), root, MONTH)
    kept = [] if touched is None else [d for d in live_directories(spark, root) if partition_of(d) not in touched]
    publish(spark, root, sorted([*kept, *made]), marks)
    logger.info("%s: %d months made anew, %d kept", root, len(made), len(kept))
    return len(made)


def refresh_parts(spark: SparkSession, silver_base: str, root: str, *, everything: bool = False) -> dict[str, int]:
    """Bring the stored partial aggregates below ``root`` up to the present Silver; months made anew by table.

    ``everything`` makes all months anew.
    """
    silver = Silver.now(spark, silver_base)
    customers, products = silver.rows(CUSTOMERS.name), silver.rows(PRODUCTS.name)
    roots = {name: f"{root}/{name}" for name in (DAYS, MONTHS, DAILY)}
    marks = {name: {} if everything else live_marks(spark, path) for name, path in roots.items()}
    touched = {name: silver.touched_months(known.get(TRANSACTIONS.name)) for name, known in marks.items()}
    made = {
        DAYS: _refresh(silver, roots[DAYS], touched[DAYS], lambda rows: customer_days(rows, by=MONTH)),
        MONTHS: _refresh(silver, roots[MONTHS], touched[MONTHS], product_months),
    }
    months = touched[DAILY]
    for dimension, column, part in ((CUSTOMERS, "country_code", DAYS), (PRODUCTS, "category", MONTHS)):
        before = marks[DAILY].get(dimension.name)
        if months is not None and before != silver.versions[dimension.name]:
            keys = silver.changed_keys(dimension.name, column, before)
            stored = read_published(spark, roots[part])
            months = None if keys is None else months | _months_of(stored, keys, dimension.key)
    daily = lambda rows: daily_part(rows, customers, products, by=MONTH)
    return made | {DAILY: _refresh(silver, roots[DAILY], months, daily)}


def parts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored partial aggregates."""
    return {name: read_published(spark, f"{root}/{name}") for name in (DAILY, DAYS, MONTHS)}
