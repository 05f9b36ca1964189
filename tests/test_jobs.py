"""The daily run on small feeds of three sources."""

import datetime as dt
import json
from pathlib import Path

import pytest

from stratamill import run
from stratamill.contracts import TRANSACTIONS
from stratamill.operators.lineage import stamp
from stratamill.plans.checks import QualityError
from stratamill.plans.jobs import (
    Lake,
    daily_run,
    ingest_full,
    ingest_source,
    layout_job,
    mart_job,
    parity_job,
    quality_job,
    read_silver,
    serve_job,
    silver_job,
)
from stratamill.plans import checks
from stratamill.sinks.published import current_version, read_published
from stratamill.sinks.written import written_once
from stratamill.sources.bronze import append_bronze, read_all_bronze

TODAY = dt.date(2024, 3, 1)


@pytest.fixture
def lake(folder):
    clouds = ("aws", "azure", "gcp")
    return Lake(
        raw={c: f"{folder}/raw/{c}" for c in clouds},
        bronze={c: f"{folder}/bronze/{c}" for c in clouds},
        silver=f"{folder}/silver",
        gold={"main": f"{folder}/gold", "replica": f"{folder}/gold_copy"},
        marts=f"{folder}/marts",
    )


def deliver(spark, lake, cloud, batch, transactions, customers=(), products=()):
    base = Path(lake.raw[cloud])
    kind = "transaction_id string, customer_id string, product_id string, amount string, txn_date string, status string"
    spark.createDataFrame(transactions, kind).coalesce(1).write.mode("append").parquet(str(base / "transactions"))
    for table in ("customers", "products"):
        (base / table).mkdir(parents=True, exist_ok=True)
    if customers:
        lines = ["customer_id,country_code,email", *[",".join(c) for c in customers]]
        (base / "customers" / f"{batch}.csv").write_text("\n".join(lines) + "\n")
    if products:
        (base / "products" / f"{batch}.json").write_text("\n".join(json.dumps(p) for p in products) + "\n")


def first_day(spark, lake):
    deliver(
        spark, lake, "aws", "1",
        [("t1", "c1", "p1", "10.005", "2024-02-20", " Completed"), ("t2", "c2", "p1", "700", "2024-01-05", "failed")],
        [("c1", " us ", "A@X.com"), ("c2", "gb", "B@X")], [{"product_id": "p1", "category": " Toys", "price": 9.99}],
    )
    deliver(
        spark, lake, "azure", "1",
        [("t3", "c1", "p2", "5.50", "2023-06-01", "completed"), ("t4", "c1", "p2", "-1", "2023-06-01", "completed")],
        [("c1", "us", "a@x.com")], [{"product_id": "p2", "category": "FOOD", "price": "1.1", "brand": "b"}],
    )
    deliver(spark, lake, "gcp", "1", [("t5", "c9", "p9", "3", "bad date", "pending"), (None, "c1", "p1", "4", "2024-01-01", "x")])


def test_two_days(spark, lake):
    first_day(spark, lake)
    statuses = daily_run(spark, lake, as_of=TODAY)
    assert all(s == {"main": "ok", "replica": "ok"} for s in statuses.values()) and len(statuses) == 3

    silver = {r.transaction_id: r for r in read_silver(spark, lake, "transactions").collect()}
    assert set(silver) == {"t1", "t2", "t3", "t5"}
    assert (silver["t1"].amount, silver["t1"].txn_year, silver["t5"].txn_date) == (10.01, 2024, None)
    customers = {r.customer_id: (r.country_code, r.email) for r in read_silver(spark, lake, "customers").collect()}
    assert customers == {"c1": ("US", "a@x.com"), "c2": ("GB", "b@x")}
    products = {r.product_id: (r.category, r.price) for r in read_silver(spark, lake, "products").collect()}
    assert products == {"p1": ("toys", 9.99), "p2": ("food", 1.1)}

    rfm = {r.customer_id: r for r in read_published(spark, f"{lake.gold['main']}/customer_rfm").collect()}
    assert (rfm["c1"].total_orders, rfm["c1"].lifetime_spend, rfm["c1"].rfm_segment) == (2, 15.51, "champion")
    assert (rfm["c2"].rfm_segment, rfm["c9"].rfm_segment, rfm["c9"].country_code) == ("loyal", "churned", None)
    mart = read_published(spark, f"{lake.marts}/mart_revenue_by_cloud")
    assert {(r.source_cloud, r.txn_year, r.txn_month, r.total_transactions) for r in mart.collect()} == {
        ("aws", 2024, 2, 1), ("aws", 2024, 1, 1), ("azure", 2023, 6, 1)
    }

    deliver(spark, lake, "gcp", "2", [("t1", "c1", "p1", "20", "2024-01-20", "completed"), ("t6", "c2", "p2", "1", "2024-02-25", "completed")])
    daily_run(spark, lake, as_of=TODAY)
    silver = {r.transaction_id: (r.amount, r.txn_month, r._cloud) for r in read_silver(spark, lake, "transactions").collect()}
    assert silver["t1"] == (20.0, 1, "gcp") and len(silver) == 5
    for target in lake.gold.values():
        daily = read_published(spark, f"{target}/daily_revenue")
        assert daily.agg({"total_transactions": "sum"}).first()[0] == 5
    assert layout_job(spark, lake)["silver-transactions"] == 0
    assert len(serve_job(spark, lake)) == 8
    report = quality_job(spark, lake).collect()
    assert len(report) == 17 and {r.status for r in report} == {"pass"}
    top = spark.sql(
        "SELECT category, sum(total_revenue) AS revenue FROM daily_revenue"
        " WHERE txn_date >= date_sub(DATE'2024-03-01', 60) GROUP BY category ORDER BY revenue DESC"
    )
    assert [tuple(r) for r in top.collect()] == [("toys", 720.0), ("food", 1.0)]
    churned = spark.sql("SELECT country_code, count(*) AS n FROM customer_rfm WHERE rfm_segment = 'churned' GROUP BY 1")
    assert [tuple(r) for r in churned.collect()] == [(None, 1)]
    assert spark.table("stg_transactions").count() == 4
    assert parity_job(spark, lake).first().status == "fail"


def test_rerun_without_news_changes_nothing(spark, lake):
    first_day(spark, lake)
    states = []
    for _ in range(2):
        for cloud in lake.raw:
            ingest_source(spark, lake, cloud)
        silver_job(spark, lake, tables=["transactions", "products"])
        states.append(
            [
                {tuple(r) for r in read_silver(spark, lake, t).drop("_silver_processed_at").collect()}
                for t in ("transactions", "products")
            ]
        )
    assert states[0] == states[1] and len(states[0][0]) == 4


def test_missing_customers_only_warn(spark, lake):
    deliver(spark, lake, "aws", "1", [("t7", None, "p1", "1", "2024-02-01", "completed")])
    ingest_source(spark, lake, "aws")
    silver_job(spark, lake, tables=["transactions"])
    assert read_silver(spark, lake, "transactions").count() == 1


def test_a_full_ingest_after_a_streamed_one_is_visible(spark, lake):
    first_day(spark, lake)
    ingest_source(spark, lake, "aws")
    before = read_all_bronze(spark, lake.bronze_of("transactions"), TRANSACTIONS).count()
    assert ingest_full(spark, lake, "aws", TRANSACTIONS)
    assert read_all_bronze(spark, lake.bronze_of("transactions"), TRANSACTIONS).count() == 2 * before


def test_failed_checks_keep_the_old_state(spark, lake, monkeypatch):
    monkeypatch.setattr(checks, "WARN_ONLY", frozenset())
    first_day(spark, lake)
    ingest_source(spark, lake, "aws")
    silver_job(spark, lake, tables=["transactions"])
    root = f"{lake.silver}/transactions"
    version = current_version(spark, root)
    deliver(spark, lake, "aws", "2", [("t7", None, "p1", "1", "2024-02-01", "completed")])
    ingest_source(spark, lake, "aws")
    with pytest.raises(QualityError, match="customer_id not_null: 1"):
        silver_job(spark, lake, tables=["transactions"])
    assert current_version(spark, root) == version
    assert read_silver(spark, lake, "transactions").filter("transaction_id = 't7'").count() == 0
    silver_job(spark, lake, tables=["transactions"], gate=False)
    assert read_silver(spark, lake, "transactions").filter("transaction_id = 't7'").count() == 1


def test_full_ingest_appends_and_skips(spark, lake):
    assert ingest_full(spark, lake, "aws", TRANSACTIONS) is False
    first_day(spark, lake)
    moment = dt.datetime(2024, 1, 1, 3)
    assert ingest_full(spark, lake, "aws", TRANSACTIONS, run_ts=moment)
    assert ingest_full(spark, lake, "aws", TRANSACTIONS, run_ts=moment)
    assert ingest_full(spark, lake, "aws", TRANSACTIONS, since=dt.datetime(2100, 1, 1)) is False
    bronze = spark.read.parquet(lake.full_of("aws", "transactions"))
    assert bronze.count() == 4 and bronze.select("_ingested_at").distinct().first()[0] == moment


def test_mart_alone(spark, lake):
    first_day(spark, lake)
    for cloud in lake.raw:
        ingest_full(spark, lake, cloud, TRANSACTIONS)
    silver_job(spark, lake, tables=["transactions"])
    mart_job(spark, lake)
    assert read_published(spark, f"{lake.marts}/mart_revenue_by_cloud").count() == 3


def test_merging_only_the_news_equals_merging_everything(spark, lake, folder):
    other = Lake(lake.raw, lake.bronze, f"{folder}/silver_all", lake.gold, lake.marts)
    days = [dt.datetime(2024, 3, 1, 3), dt.datetime(2024, 3, 2, 3), dt.datetime(2024, 3, 3, 3)]
    batches = [
        [("a", "c", "p", "1", "2024-01-01", "x"), ("b", "c", "p", "2", "2024-01-01", "x"), ("d", "c", "p", "3", None, "x")],
        [("a", "c", "p", "9", "2024-02-01", "x"), ("b", "c", "p", "-2", "2024-01-01", "x"), ("e", "c", "p", "-1", None, "x")],
        [("a", "c", "p", "bad", "2024-02-01", "x"), ("d", "c", "p", "4", "2023-01-01", "x"), ("e", "c", "p", "5", None, "x")],
    ]
    for day, batch in zip(days, batches, strict=True):
        path = f"{folder}/feed/{day:%d}"
        kind = "transaction_id string, customer_id string, product_id string, amount string, txn_date string, status string"
        spark.createDataFrame(batch, kind).write.parquet(path)
        append_bronze(stamp(spark.read.parquet(path), "feed", "aws", run_ts=day), lake.bronze_of("transactions")["aws"])
        silver_job(spark, lake, tables=["transactions"], since=day.date(), run_ts=day)
        silver_job(spark, other, tables=["transactions"], run_ts=day)
        news, everything = (
            {tuple(r) for r in read_silver(spark, where, "transactions").drop("_silver_processed_at").collect()} for where in (lake, other)
        )
        assert news == everything
    assert {r.transaction_id: r.amount for r in read_silver(spark, lake, "transactions").collect()} == {"a": 9.0, "b": 2.0, "d": 4.0, "e": 5.0}


def test_command_line(spark, lake, folder):
    first_day(spark, lake)
    places = Path(folder) / "lake.json"
    places.write_text(json.dumps(vars(lake)))
    loaded = Lake(**json.loads(places.read_text()))
    assert run.run(spark, loaded, run.arguments([str(places), "ingest", "--source", "aws"])) == {
        "aws": {"customers": True, "transactions": True, "products": True}
    }
    run.run(spark, loaded, run.arguments([str(places), "silver", "--since", "2024-01-01"]))
    assert set(run.run(spark, loaded, run.arguments([str(places), "gold", "--as-of", "2024-03-01"]))) == {
        "daily_revenue", "customer_rfm", "product_performance"
    }
    run.run(spark, loaded, run.arguments([str(places), "mart", "--no-gate"]))
    assert run.run(spark, loaded, run.arguments([str(places), "parity"]))["status"] == "fail"
    with pytest.raises(SystemExit):
        run.arguments([str(places), "unknown"])


def test_written_once_keeps_rows_and_types(spark):
    frame = spark.range(5).selectExpr("id", "timestamp_ntz'2024-01-01 01:00:00' as t", "cast(1 as decimal(18,2)) as d")
    copy = written_once(frame)
    assert copy.dtypes == frame.dtypes and copy.exceptAll(frame).count() == 0 and copy.count() == 5
    assert "written-" in copy.inputFiles()[0]
