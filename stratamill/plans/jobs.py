"""The jobs of a daily run, from raw feeds to checked, served tables."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.contracts import CONTRACTS, CUSTOMERS, GOLD_CLUSTER_BY, LINEAGE_COLUMNS, PRODUCTS, TRANSACTIONS, TableContract
from stratamill.functions.days import AsOf, RunTime
from stratamill.operators.combine import union_sources
from stratamill.operators.lineage import stamp
from stratamill.operators.quality import Observed, parity
from stratamill.plans import checks, refresh
from stratamill.plans.gold import daily_from, performance_from, rfm_from
from stratamill.plans.maintenance import TARGET_FILE_BYTES, LayoutTask, maintain
from stratamill.plans.marts import mart_revenue_by_cloud, stg_transactions
from stratamill.plans.silver import silver_table
from stratamill.sinks.published import (
    live_directories,
    live_marks,
    publish,
    read_directories,
    read_published,
    stage,
    stage_upsert,
)
from stratamill.sinks.replicate import repair, replicate_directories
from stratamill.sources.batches import add_batch, compact_days
from stratamill.sources.bronze import read_all_bronze, unmerged_bronze
from stratamill.sources.files import read_new_files
from stratamill.sources.serving import as_view, serve
from stratamill.streaming.feed_schema import as_text, keep_wider, stored_schema
from stratamill.streaming.ingest import ingest_available

logger = logging.getLogger(__name__)

# The mark that tells when the newest row was ingested, in microseconds; no source has such a name.
NEWEST = "@newest"


@dataclass(frozen=True)
class Lake:
    """Where everything lives. ``raw`` and ``bronze`` map a source label to a directory,
    ``gold`` maps target labels to directories, the primary one first."""

    raw: Mapping[str, str] = field(hash=False)
    bronze: Mapping[str, str] = field(hash=False)
    silver: str
    gold: Mapping[str, str] = field(hash=False)
    marts: str

    @property
    def parts(self) -> str:
        """The Gold models' partial aggregates, beside the primary models."""
        return f"{next(iter(self.gold.values()))}/parts"

    def bronze_of(self, table: str) -> dict[str, str]:
        """The table's Bronze directories of every source: what the stream and what full ingests delivered."""
        streamed = {cloud: f"{base}/{table}" for cloud, base in self.bronze.items()}
        return streamed | {f"{cloud} (full)": self.full_of(cloud, table) for cloud in self.bronze}

    def full_of(self, cloud: str, table: str) -> str:
        """Where full ingests go; the stream's directory is its own."""
        return f"{self.bronze[cloud]}/full/{table}"


def ingest_full(
    spark: SparkSession, lake: Lake, cloud: str, contract: TableContract, run_ts: RunTime = None, since=None
) -> bool:
    """Add a feed to Bronze as one batch: all its files, or those modified after ``since``.

    As with the stream, single values of JSON are text, and the columns are kept beside.
    """
    feed = f"{lake.raw[cloud]}/{contract.name}"
    rows = read_new_files(spark, feed, contract.feed_format, since=since)
    if rows is None:
        logger.info("no new files for %s from %s", contract.name, cloud)
        return False
    if contract.feed_format == "json":
        rows = read_new_files(spark, feed, "json", since=since, schema=as_text(rows.schema))
    keep_wider(spark, f"{lake.bronze[cloud]}/checkpoints/{contract.name}-full-schema", rows.schema)
    add_batch(stamp(rows, feed, cloud, run_ts=run_ts), lake.full_of(cloud, contract.name), uuid.uuid4().hex)
    return True


def ingest_incremental(spark: SparkSession, lake: Lake, cloud: str, contract: TableContract) -> bool:
    """Append the feed files not ingested before."""
    feed = f"{lake.raw[cloud]}/{contract.name}"
    base = lake.bronze[cloud]
    return ingest_available(
        spark,
        feed,
        f"{base}/{contract.name}",
        f"{base}/checkpoints/{contract.name}",
        contract.feed_format,
        source=feed,
        cloud=cloud,
    )


def _stored_schemas(spark: SparkSession, lake: Lake, table: str) -> dict[str, T.StructType]:
    """By source, the columns of what was ingested into Bronze, so that no footer of its history is read."""
    lineage = [T.StructField(c, T.TimestampType() if c == "_ingested_at" else T.StringType()) for c in LINEAGE_COLUMNS]
    found = {}
    for cloud, base in lake.bronze.items():
        for source, store in ((cloud, f"{table}-schema"), (f"{cloud} (full)", f"{table}-full-schema")):
            feed = stored_schema(spark, f"{base}/checkpoints/{store}")
            if feed is not None:
                own = [f for f in lineage if f.name != "_date_part"] + [T.StructField("_date_part", T.DateType())]
                found[source] = T.StructType([*feed.fields, *own])
    return found


def ingest_source(spark: SparkSession, lake: Lake, cloud: str) -> dict[str, bool]:
    """Ingest every table of one source; tells which had a feed."""
    return {c.name: ingest_incremental(spark, lake, cloud, c) for c in CONTRACTS.values()}


def silver_job(
    spark: SparkSession,
    lake: Lake,
    *,
    tables: Sequence[str] = tuple(CONTRACTS),
    since: dt.date | None = None,
    everything: bool = False,
    order_by: str | None = None,
    run_ts: RunTime = None,
    gate: bool = True,
) -> None:
    """Unite, deduplicate, cleanse and merge each table.

    Every published version carries, by source, the newest ingest batch that is merged
    into it, in the same list as its directories. Only batches behind that are read, and
    a run that dies before it publishes has merged nothing, so none is merged twice and
    none is left out. The result is that of reading all of Bronze: the latest row of a key
    is in the last batch that has the key, and merging never deletes. The cost then
    follows the news, not the history. Without news there is no new version.

    ``since`` takes the Bronze rows ingested from that day on instead, merged before or
    not; ``everything`` takes all.

    The merge is written and, with ``gate``, checked before it is published: row rules are
    counted while the incoming rows are written, and the directories written are read for
    uniqueness alone (the others hold none of the incoming keys). :func:`quality_job`
    checks whole tables.
    """
    for name in tables:
        contract = CONTRACTS[name]
        root = f"{lake.silver}/{name}"
        merged = {} if everything else live_marks(spark, root)
        bronze, marks = unmerged_bronze(
            spark, lake.bronze_of(name), contract, _stored_schemas(spark, lake, name), since, merged
        )
        if bronze is None:
            logger.info("nothing new for %s", name)
            continue
        batch = silver_table(bronze, contract, run_ts=run_ts)
        observed = checks.observed_transactions(batch, tuple(lake.bronze)) if contract is TRANSACTIONS else None
        before = live_directories(spark, root)
        rows = batch if observed is None else observed.rows
        directories = stage_upsert(rows, root, contract.key, contract.partition_by, order_by)
        known = {d.split("/")[0] for d in before}
        changed = [d for d in directories if d.split("/")[0] not in known]
        if gate and changed and observed is not None:
            staged = stg_transactions(read_directories(spark, root, changed, like=directories))
            checks.enforce(observed.report(), checks.staging_key_check(staged))
        if observed is not None:
            newest = [n for n in (live_marks(spark, root).get(NEWEST), observed.total("newest")) if n is not None]
            marks |= {NEWEST: max(newest)} if newest else {}
        publish(spark, root, directories, marks)


def freshness_gate(spark: SparkSession, lake: Lake) -> None:
    """Raise unless the newest Silver transaction was ingested less than a day ago.

    Its time is a mark of the published version, so that nothing is read.
    """
    newest = live_marks(spark, f"{lake.silver}/transactions").get(NEWEST)
    now = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1_000_000)
    checks.enforce(checks.freshness_of(spark, newest, now))


def read_silver(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """One Silver table."""
    return read_published(spark, f"{lake.silver}/{table}")


def gold_job(
    spark: SparkSession,
    lake: Lake,
    *,
    as_of: AsOf = None,
    run_ts: RunTime = None,
    gate: bool = True,
    everything: bool = False,
) -> dict[str, dict[str, str]]:
    """Build the three models and publish each to all targets; returns the status per target.

    Their partial aggregates are stored by month beside the primary target, and only months that
    changed since the last run are read again (:mod:`stratamill.plans.refresh`); with
    ``everything``, all are. Each model is finished once, into the primary target; its checks
    are counted while it is written, and the copies read what was written. Its counts have to
    add up to the transactions, so that a join which repeated some is stopped, and a stored
    month that is not the transactions' as well.
    """
    transactions, customers, products = (
        read_silver(spark, lake, c.name) for c in (TRANSACTIONS, CUSTOMERS, PRODUCTS)
    )
    refresh.refresh_parts(spark, lake.silver, lake.parts, everything=everything)
    stored = refresh.parts(spark, lake.parts)
    models = [
        Observed(
            daily_from(stored[refresh.DAILY], run_ts=run_ts),
            "daily_revenue",
            checks.daily_rules(),
            total=F.sum("total_transactions"),
        ),
        Observed(
            rfm_from(stored[refresh.DAYS], customers, as_of=as_of, run_ts=run_ts), "customer_rfm", checks.rfm_rules()
        ),
        Observed(
            performance_from(stored[refresh.MONTHS], products, run_ts=run_ts),
            "product_performance",
            total=F.sum("units_sold"),
        ),
    ]
    counted = {"daily_revenue": "total_transactions", "product_performance": "units_sold"}
    n_rows = transactions.count() if gate else 0
    primary = next(iter(lake.gold.values()))
    statuses = {}
    for observed in models:
        directories = stage(observed.rows, f"{primary}/{observed.model}")
        if gate:
            column = counted.get(observed.model)
            sums = [checks.conservation_of(observed, column, n_rows)] if column else []
            checks.enforce(*[observed.report()] * bool(observed.rules), *sums)
        statuses[observed.model] = replicate_directories(spark, observed.model, directories, lake.gold)
    return statuses


def repair_job(spark: SparkSession, lake: Lake) -> dict[str, dict[str, str]]:
    """Compare the copies of the Gold models with the primary ones, row by row, and mend what differs."""
    primary = next(iter(lake.gold.values()))
    return {name: repair(spark, name, lake.gold) for name in GOLD_CLUSTER_BY if live_directories(spark, f"{primary}/{name}")}


def mart_job(spark: SparkSession, lake: Lake, *, run_ts: RunTime = None, gate: bool = True) -> None:
    """Build the revenue mart from the staging view and publish it."""
    root = f"{lake.marts}/mart_revenue_by_cloud"
    mart = mart_revenue_by_cloud(stg_transactions(read_silver(spark, lake, "transactions")), run_ts=run_ts)
    observed = Observed(mart, "mart_revenue_by_cloud", checks.mart_rules())
    directories = stage(observed.rows, root)
    if gate:
        checks.enforce(observed.report())
    publish(spark, root, directories)


def upkeep_job(spark: SparkSession, lake: Lake, before: dt.date | None = None) -> dict[str, int]:
    """Compact Bronze days that the ingest adds nothing to any more: those before ``before``, by default today.

    Returns the directories replaced by table and source. One failure does not stop the
    others, and all are raised at the end.
    """
    before = before or dt.datetime.now(dt.timezone.utc).date()
    replaced, failed = {}, []
    for table in CONTRACTS:
        schemas = _stored_schemas(spark, lake, table)
        for source, root in lake.bronze_of(table).items():
            label = f"bronze-{table}-{source}"
            try:
                replaced[label] = compact_days(spark, root, before, TARGET_FILE_BYTES, schemas.get(source))
            except Exception:  # each table stands alone; the sweep reports all failures together
                logger.exception("upkeep of %s failed", label)
                failed.append(label)
    if failed:
        raise RuntimeError(f"upkeep failed for: {failed}")
    return {label: count for label, count in replaced.items() if count}


def layout_job(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Cluster the Silver and Gold tables."""
    primary = next(iter(lake.gold.values()))
    tasks = [
        LayoutTask(f"silver-{c.name}", f"{lake.silver}/{c.name}", c.cluster_by, c.partition_by, c.key)
        for c in CONTRACTS.values()
    ]
    tasks += [LayoutTask(f"gold-{name}", f"{primary}/{name}", columns) for name, columns in GOLD_CLUSTER_BY.items()]
    return maintain(spark, [t for t in tasks if live_directories(spark, t.root)])


def serve_job(spark: SparkSession, lake: Lake) -> list[str]:
    """Expose Silver, the staging view, the primary Gold models and the mart to SQL; returns the names served."""
    primary = next(iter(lake.gold.values()))
    roots = {name: f"{lake.silver}/{name}" for name in CONTRACTS}
    roots |= {name: f"{primary}/{name}" for name in GOLD_CLUSTER_BY}
    roots["mart_revenue_by_cloud"] = f"{lake.marts}/mart_revenue_by_cloud"
    served = [name for name, root in roots.items() if live_directories(spark, root)]
    for name in served:
        serve(spark, roots[name], name)
    if "transactions" in served:
        as_view(stg_transactions(spark.table("transactions")), "stg_transactions")
        served.append("stg_transactions")
    return served


def quality_job(spark: SparkSession, lake: Lake) -> DataFrame:
    """All checks over the whole published tables, one row per rule."""
    primary = next(iter(lake.gold.values()))
    silver = read_silver(spark, lake, "transactions")
    staged = stg_transactions(silver)
    performance = read_published(spark, f"{primary}/product_performance")
    return union_sources(
        [
            checks.freshness_check(silver, "silver_transactions"),
            checks.conservation_check(performance, silver),
            checks.silver_contract_checks(silver),
            checks.staging_checks(staged, tuple(lake.bronze)),
            checks.staging_key_check(staged),
            checks.daily_checks(read_published(spark, f"{primary}/daily_revenue")),
            checks.rfm_checks(read_published(spark, f"{primary}/customer_rfm")),
            checks.mart_checks(read_published(spark, f"{lake.marts}/mart_revenue_by_cloud")),
        ]
    )


def parity_job(
    spark: SparkSession,
    lake: Lake,
    table: str = "transactions",
    since: dt.date | None = None,
    tolerance: float = 0.05,
) -> DataFrame:
    """Row counts of the Bronze sources against each other, over all ingest days or those from ``since`` on."""
    bronze = read_all_bronze(spark, lake.bronze_of(table), CONTRACTS[table], _stored_schemas(spark, lake, table), since)
    return parity(bronze, f"bronze_{table}", tuple(lake.bronze), tolerance=tolerance)


def daily_run(
    spark: SparkSession,
    lake: Lake,
    *,
    since: dt.date | None = None,
    as_of: AsOf = None,
    run_ts: RunTime = None,
    gate: bool = True,
) -> dict[str, dict[str, str]]:
    """Bronze, Silver, Gold, mart, upkeep, layout, source parity, in this order; returns the Gold statuses.

    The Silver merge takes the ingest batches not yet merged, or with ``since`` all from that day on.
    """
    for cloud in lake.raw:
        ingest_source(spark, lake, cloud)
    silver_job(spark, lake, since=since, run_ts=run_ts, gate=gate)
    if gate:
        freshness_gate(spark, lake)
    statuses = gold_job(spark, lake, as_of=as_of, run_ts=run_ts, gate=gate)
    mart_job(spark, lake, run_ts=run_ts, gate=gate)
    upkeep_job(spark, lake)
    layout_job(spark, lake)
    result = parity_job(spark, lake, since=since).first()
    if result.status != "pass":
        logger.warning("source row counts differ: %s", result)
    return statuses
