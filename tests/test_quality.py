import datetime as dt

import pytest

from stratamill.operators.quality import (
    castable,
    conservation,
    contract_rules,
    freshness,
    in_range,
    not_null,
    one_of,
    parity,
    profile,
    repeated_values,
    unique,
)
from stratamill.plans.checks import QualityError, enforce, mart_checks, staging_checks


def lines(df):
    return {(r.check, r.column_name): (r.violations, r.status) for r in df.collect()}


def test_row_rules_in_one_pass(spark):
    df = spark.createDataFrame(
        [("a", 0.0, "aws", "1"), (None, -1.0, "moon", "x"), ("c", None, None, None), ("d", 101.0, "gcp", "2.5")],
        "k string, v double, cloud string, raw string",
    )
    rules = [not_null("k"), in_range("v", 0, 100), in_range("v", low=0), one_of("cloud", ["aws", "gcp"]), castable("raw", "double")]
    checked = profile(df, "m", rules)
    assert checked._jdf.queryExecution().executedPlan().toString().count("Exchange SinglePartition") == 1
    assert checked.columns == ["model", "check", "column_name", "violations", "status"]
    assert [(r.check, r.violations, r.status) for r in checked.collect()] == [
        ("not_null", 1, "fail"),
        ("accepted_range", 2, "fail"),
        ("accepted_range", 1, "fail"),
        ("accepted_values", 1, "fail"),
        ("type_double", 1, "fail"),
    ]


def test_empty_table_passes_row_rules(spark):
    df = spark.createDataFrame([], "k string")
    assert lines(profile(df, "m", [not_null("k")])) == {("not_null", "k"): (0, "pass")}


def test_missing_contract_column_breaks_every_row(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    got = lines(profile(df, "m", contract_rules(df, {"a": "int", "b": "date"})))
    assert got == {("type_int", "a"): (1, "fail"), ("type_date", "b"): (2, "fail")}


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("b",), ("c",), (None,), (None,)], "k string")
    assert {(r.k, r.n_rows) for r in repeated_values(df, "k").collect()} == {("a", 2), ("b", 3)}
    assert lines(unique(df, "m", "k")) == {("unique", "k"): (2, "fail")}
    assert lines(unique(df.distinct(), "m", "k")) == {("unique", "k"): (0, "pass")}


@pytest.mark.parametrize(
    "age, status", [(0, "pass"), (6 * 3600, "pass"), (6 * 3600 + 1, "warn"), (24 * 3600, "warn"), (24 * 3600 + 1, "error")]
)
def test_freshness_limits(spark, age, status):
    newest = dt.datetime(2024, 1, 5, 12)
    df = spark.createDataFrame([(newest,), (newest - dt.timedelta(days=9),), (None,)], "t timestamp")
    row = freshness(df, "m", "t", newest + dt.timedelta(seconds=age)).first()
    assert (row.newest, row.age_us, row.status) == (newest, age * 1_000_000, status)


def test_freshness_of_nothing_is_an_error(spark):
    assert freshness(spark.createDataFrame([], "t timestamp"), "m", "t").first().status == "error"


def test_parity(spark):
    df = spark.createDataFrame([("aws",)] * 100 + [("gcp",)] * 95 + [("azure",)] * 98, "_cloud string")
    row = parity(df, "m", ("aws", "azure", "gcp")).first()
    assert (row.least_rows, row.most_rows, row.gap, row.status) == (95, 100, 0.05, "pass")
    assert parity(df, "m", ("aws", "gcp"), tolerance=0.04).first().status == "fail"
    assert parity(df, "m", ("aws", "mars")).first().status == "fail"
    assert parity(df.limit(0), "m", ("aws", "gcp")).first().status == "fail"
    assert parity(df, "m", ("aws",)).first().status == "pass"


def test_conservation_sees_fan_out(spark):
    rows = spark.range(5)
    assert conservation(rows.selectExpr("1L as units"), "units", rows).first().status == "pass"
    assert conservation(rows.selectExpr("2L as units"), "units", rows).first().status == "fail"
    assert conservation(rows.selectExpr("1L as units").limit(0), "units", rows.limit(0)).first().status == "pass"


def test_the_gate_names_what_failed(spark, caplog):
    staged = spark.createDataFrame([("t", None, 1.0, "moon")], "transaction_id string, customer_id string, amount double, source_cloud string")
    with pytest.raises(QualityError) as error:
        enforce(staging_checks(staged))
    assert "source_cloud accepted_values: 1" in str(error.value)
    # A missing customer is reported and blocks nothing.
    assert "customer_id" not in str(error.value) and "customer_id not_null: 1" in caplog.text
    mart = spark.createDataFrame([(1.0, 100.0)], "total_revenue double, completion_rate_pct double")
    assert len(enforce(mart_checks(mart))) == 2
    bad = spark.createDataFrame([(0.0, 100.01)], "total_revenue double, completion_rate_pct double")
    with pytest.raises(QualityError):
        enforce(mart_checks(bad))
