"""Bronze batches: what a merge reads, and days that are compacted."""

import datetime as dt

import pytest
from test_jobs import TODAY, deliver, first_day, lake  # noqa: F401

from stratamill.contracts import TRANSACTIONS
from stratamill.operators.lineage import stamp
from stratamill.plans import checks, jobs
from stratamill.plans.checks import QualityError
from stratamill.sinks import published
from stratamill.sinks.published import current_version, list_files
from stratamill.sources import batches
from stratamill.sources.bronze import read_all_bronze, read_bronze, unmerged_bronze

TOMORROW = dt.datetime.now(dt.timezone.utc).date() + dt.timedelta(days=2)


def live_marks(spark, root):
    return {name: n for name, n in published.live_marks(spark, root).items() if name != jobs.NEWEST}


def silver(spark, lake):  # noqa: F811
    return {tuple(r) for r in jobs.read_silver(spark, lake, "transactions").drop("_silver_processed_at").collect()}


def next_day(spark, lake, n):  # noqa: F811
    rows = [(f"t{n}", "c1", "p1", str(n), "2024-02-20", "completed"), ("t1", "c1", "p1", str(100 + n), "2024-02-21", "x")]
    deliver(spark, lake, "aws", str(n), rows, [(f"c{n}", "us", "x@y")])


def test_a_second_run_reads_only_new_batches(spark, lake, monkeypatch):  # noqa: F811
    first_day(spark, lake)
    jobs.daily_run(spark, lake, as_of=TODAY)
    root = f"{lake.silver}/transactions"
    assert live_marks(spark, root) == {"aws": 1, "azure": 1, "gcp": 1}
    version = current_version(spark, root)
    jobs.silver_job(spark, lake)
    assert current_version(spark, root) == version  # no news, no version

    opened = []
    reading = batches.read_batches

    def spied(session, path, directories, schema=None):
        opened.append((path, len(directories), schema is not None))
        return reading(session, path, directories, schema)

    monkeypatch.setattr("stratamill.sources.bronze.read_batches", spied)
    next_day(spark, lake, 10)
    jobs.ingest_source(spark, lake, "aws")
    jobs.silver_job(spark, lake, tables=["transactions"])
    assert opened == [(f"{lake.bronze['aws']}/transactions", 1, True)]  # by the stored schema, no footers
    assert live_marks(spark, root) == {"aws": 2, "azure": 1, "gcp": 1}
    jobs.layout_job(spark, lake)
    assert live_marks(spark, root) == {"aws": 2, "azure": 1, "gcp": 1}  # kept by other writers
    before = silver(spark, lake)
    jobs.silver_job(spark, lake, tables=["transactions"], everything=True)
    assert silver(spark, lake) == before and "t10" in {r[0] for r in before}


def test_a_merge_that_dies_is_done_again_once(spark, lake, monkeypatch):  # noqa: F811
    first_day(spark, lake)
    jobs.ingest_source(spark, lake, "aws")
    jobs.silver_job(spark, lake, tables=["transactions"])
    next_day(spark, lake, 10)
    jobs.ingest_source(spark, lake, "aws")
    root = f"{lake.silver}/transactions"
    with monkeypatch.context() as patch:
        patch.setattr(checks, "enforce", lambda *_: (_ for _ in ()).throw(QualityError("stopped")))
        with pytest.raises(QualityError):
            jobs.silver_job(spark, lake, tables=["transactions"])
    assert live_marks(spark, root) == {"aws": 1}
    jobs.silver_job(spark, lake, tables=["transactions"])
    assert live_marks(spark, root) == {"aws": 2}
    assert {r[0] for r in silver(spark, lake)} == {"t1", "t2", "t10"}


def test_full_ingests_are_merged_once_and_need_no_footers(spark, lake):  # noqa: F811
    first_day(spark, lake)
    jobs.ingest_source(spark, lake, "aws")
    assert jobs.ingest_full(spark, lake, "aws", TRANSACTIONS)
    places = lake.bronze_of("transactions")
    schemas = jobs._stored_schemas(spark, lake, "transactions")
    assert set(schemas) == {"aws", "aws (full)"}
    rows, marks = unmerged_bronze(spark, places, TRANSACTIONS, schemas)
    assert rows.count() == 4 and marks == {"aws": 1, "aws (full)": 1}
    rows, marks = unmerged_bronze(spark, places, TRANSACTIONS, schemas, merged={"aws": 1})
    assert rows.count() == 2 and marks == {"aws": 1, "aws (full)": 1}
    assert unmerged_bronze(spark, places, TRANSACTIONS, schemas, merged=marks)[0] is None


def test_since_moves_no_mark_over_what_it_left_out(spark, folder):
    day = dt.datetime(2024, 3, 1, 3)
    for n in range(3):
        rows = spark.createDataFrame([(f"t{n}",)], "transaction_id string")
        batches.add_batch(stamp(rows, "s", "aws", run_ts=day + dt.timedelta(days=n)), folder, f"token{n}")
    places = {"aws": folder}
    rows, marks = unmerged_bronze(spark, places, TRANSACTIONS, since=dt.date(2024, 3, 3), merged={"aws": 1})
    assert rows.count() == 1 and marks == {"aws": 1}
    rows, marks = unmerged_bronze(spark, places, TRANSACTIONS, since=dt.date(2024, 3, 2), merged={"aws": 1})
    assert rows.count() == 2 and marks == {"aws": 3}
    assert read_all_bronze(spark, places, TRANSACTIONS, since=dt.date(2025, 1, 1)).count() == 0


def test_closed_days_are_compacted_while_the_ingest_goes_on(spark, lake, monkeypatch):  # noqa: F811
    first_day(spark, lake)
    for n in range(10, 14):
        next_day(spark, lake, n)
        jobs.ingest_source(spark, lake, "aws")
    jobs.silver_job(spark, lake)
    root = f"{lake.bronze['aws']}/transactions"
    before = read_bronze(spark, root)
    rows, live = sorted(map(str, before.collect())), batches.live_batches(spark, root)
    files = list_files(spark, root, live).count()
    assert len(live) == 4 and batches.compact_days(spark, root, dt.date(2000, 1, 1), 1 << 20) == 0
    writing = batches._write

    def meanwhile(*args):
        with monkeypatch.context() as patch:
            patch.setattr(batches, "_write", writing)
            next_day(spark, lake, 14)
            jobs.ingest_source(spark, lake, "aws")
        return writing(*args)

    with monkeypatch.context() as patch:
        patch.setattr(batches, "_write", meanwhile)
        assert batches.compact_days(spark, root, TOMORROW, 1 << 20) == 4
    live = batches.live_batches(spark, root)
    assert len(live) == 2 and list_files(spark, root, live).count() < files
    got = sorted(map(str, batches.read_batches(spark, root, [live[0]]).select(before.columns).collect()))
    assert got == rows
    # The compacted batches count as merged; the one that came meanwhile is news.
    rows, marks = unmerged_bronze(spark, {"aws": root}, TRANSACTIONS, merged=live_marks(spark, f"{lake.silver}/transactions"))
    assert {r.transaction_id for r in rows.collect()} == {"t14", "t1"} and marks["aws"] == 5
    assert batches.compact_days(spark, root, TOMORROW, 1 << 20) == 2
    assert len(batches.live_batches(spark, root)) == 1
    jobs.silver_job(spark, lake)
    assert {"t10", "t13", "t14"} <= {r[0] for r in silver(spark, lake)}


def test_upkeep_of_all_sources(spark, lake):  # noqa: F811
    first_day(spark, lake)
    for n in (10, 11):
        next_day(spark, lake, n)
        jobs.ingest_source(spark, lake, "aws")
    assert jobs.upkeep_job(spark, lake) == {}  # today is not closed
    assert jobs.upkeep_job(spark, lake, TOMORROW) == {"bronze-transactions-aws": 2, "bronze-customers-aws": 2}
    assert jobs.upkeep_job(spark, lake, TOMORROW) == {}
