"""Gold by change against full builds."""

import datetime as dt

import pytest

from stratamill.contracts import CUSTOMERS, PRODUCTS, TRANSACTIONS
from stratamill.plans import refresh
from stratamill.plans.gold import (
    customer_rfm,
    daily_from,
    daily_revenue,
    performance_from,
    product_performance,
    rfm_from,
)
from stratamill.sinks.published import current_version, live_directories, read_published, replace_published, upsert_published

TXN = (
    "transaction_id string, customer_id string, product_id string, amount double, txn_date date,"
    " txn_year int, txn_month int"
)
TODAY = dt.date(2024, 4, 1)


def txn(i, customer, product, amount, day):
    day = day and dt.date.fromisoformat(day)
    return (i, customer, product, amount, day, day and day.year, day and day.month)


FIRST = [
    txn("t1", "c1", "p1", 10.01, "2024-01-05"),
    txn("t2", "c1", "p1", 700.0, "2024-01-05"),
    txn("t3", "c2", "p2", None, "2024-02-07"),
    txn("t4", None, "p2", 3.5, "2024-02-07"),
    txn("t5", "c9", "p9", 1.0, None),
    txn("t6", "c3", "p1", 0.1, "2024-03-30"),
]


@pytest.fixture
def store(spark, folder):
    return Store(spark, folder)


class Store:
    def __init__(self, spark, folder):
        self.spark, self.silver, self.root = spark, f"{folder}/silver", f"{folder}/parts"
        self.merge(FIRST)
        self.customers([("c1", "US"), ("c2", "GB"), ("c3", None)])
        self.products([("p1", "toys"), ("p2", "food")])

    def merge(self, rows):
        frame = self.spark.createDataFrame(rows, TXN)
        upsert_published(frame, f"{self.silver}/transactions", TRANSACTIONS.key, TRANSACTIONS.partition_by)

    def customers(self, rows):
        replace_published(self.spark.createDataFrame(rows, "customer_id string, country_code string"), f"{self.silver}/customers")

    def products(self, rows):
        replace_published(self.spark.createDataFrame(rows, "product_id string, category string"), f"{self.silver}/products")

    def refresh(self, **kwargs):
        """Months made anew by table; the models have to be those of a full build."""
        made = refresh.refresh_parts(self.spark, self.silver, self.root, **kwargs)
        stored = refresh.parts(self.spark, self.root)
        silver = [read_published(self.spark, f"{self.silver}/{c.name}") for c in (TRANSACTIONS, CUSTOMERS, PRODUCTS)]
        transactions, customers, products = silver
        for part, full in (
            (daily_from(stored[refresh.DAILY]), daily_revenue(transactions, customers, products)),
            (rfm_from(stored[refresh.DAYS], customers, as_of=TODAY), customer_rfm(transactions, customers, as_of=TODAY)),
            (performance_from(stored[refresh.MONTHS], products), product_performance(transactions, products)),
        ):
            columns = [c for c in full.columns if c != "_gold_built_at"]
            assert part.dtypes == full.dtypes
            assert sorted(map(str, part.select(columns).collect())) == sorted(map(str, full.select(columns).collect()))
        return made[refresh.DAYS], made[refresh.MONTHS], made[refresh.DAILY]


def test_only_changed_months_are_made_anew(store):
    assert store.refresh() == (4, 4, 4)
    versions = [current_version(store.spark, f"{store.root}/{name}") for name in (refresh.DAYS, refresh.DAILY)]
    assert store.refresh() == (0, 0, 0)
    assert versions == [current_version(store.spark, f"{store.root}/{name}") for name in (refresh.DAYS, refresh.DAILY)]

    before = set(live_directories(store.spark, f"{store.root}/{refresh.DAYS}"))
    store.merge([txn("t7", "c1", "p2", 20.0, "2024-02-08")])
    assert store.refresh() == (1, 1, 1)
    after = set(live_directories(store.spark, f"{store.root}/{refresh.DAYS}"))
    assert {d.split("/", 1)[1] for d in before - after} == {"txn_year=2024/txn_month=2"} and len(before & after) == 3

    # A correction, a new month, and a dated row in place of an undated one, which leaves its month empty.
    store.merge([txn("t1", "c1", "p1", 11.0, "2024-01-05"), txn("t8", "c8", "p1", 5.0, "2023-12-31")])
    assert store.refresh() == (2, 2, 2)
    store.merge([txn("t5", "c9", "p9", 1.0, "2024-03-02")])
    assert store.refresh() == (1, 1, 1)
    assert not any("HIVE_DEFAULT" in d for d in live_directories(store.spark, f"{store.root}/{refresh.MONTHS}"))
    store.merge([txn("t3", "c2", "p2", 9.0, None)])
    assert store.refresh() == (2, 2, 2)


def test_dimensions_touch_the_months_their_keys_occur_in(store):
    store.refresh()
    store.customers([("c1", "US"), ("c2", "FR"), ("c3", None), ("c4", "US")])
    assert store.refresh() == (0, 0, 1)
    # The undated order has an unknown product, which is one now; a repeated customer repeats facts in every build.
    store.products([("p1", "toys"), ("p2", "food"), ("p9", "new")])
    assert store.refresh() == (0, 0, 1)
    store.customers([("c1", "US"), ("c2", "FR"), ("c2", "FR"), ("c3", "NO"), (None, "US")])
    assert store.refresh() == (0, 0, 2)
    store.products([("p1", "games"), ("p2", "food"), ("p9", "new")])
    store.merge([txn("t9", "c2", "p2", 2.0, "2024-02-01")])
    assert store.refresh() == (1, 1, 3)


def test_without_the_older_list_all_months_are_made_anew(store, monkeypatch):
    store.refresh()
    assert store.refresh(everything=True) == (4, 4, 4)
    store.merge([txn("t7", "c1", "p2", 20.0, "2024-02-08")])
    own = refresh.directories_at
    newest = current_version(store.spark, f"{store.silver}/transactions")
    monkeypatch.setattr(refresh, "directories_at", lambda spark, root, v: own(spark, root, v) if v == newest or "/tr" not in root else None)
    assert store.refresh() == (4, 4, 4)


def test_a_run_that_died_between_two_tables_is_taken_up(store, monkeypatch):
    store.refresh()
    store.merge([txn("t7", "c1", "p2", 20.0, "2024-02-08")])
    with monkeypatch.context() as patch:
        patch.setattr(refresh, "product_months", lambda rows: rows.select("no_such_column"))
        with pytest.raises(Exception, match="no_such_column"):
            refresh.refresh_parts(store.spark, store.silver, store.root)
    assert store.refresh() == (0, 1, 1)


def test_unpublished_silver_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError, match="transactions"):
        refresh.refresh_parts(spark, f"{folder}/silver", f"{folder}/parts")
