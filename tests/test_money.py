import math
import random
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratamill.functions.money import from_cents, money_per, percent_of, to_cents, to_money


def total(df):
    return df.agg(from_cents(F.sum(to_cents("amount"))).alias("t")).first().t


def test_totals_do_not_depend_on_order(spark):
    rng = random.Random(5)
    cents = [rng.randrange(1, 10**9) for _ in range(5000)]
    exact = float(Decimal(sum(cents)) / 100)
    for _ in range(3):
        rng.shuffle(cents)
        df = spark.createDataFrame([(c / 100,) for c in cents], "amount double").repartition(7)
        assert total(df) == exact


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=40))
def test_totals_are_exact(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "amount double")
    assert total(df) == float(Decimal(sum(cents)) / 100)


def test_totals_are_one_value_however_large(spark):
    rng = random.Random(8)
    amounts = [rng.randrange(10**14, 10**16) / 100 for _ in range(4000)] + [1e17, 0.01, 9.99]
    frame = spark.createDataFrame([(a,) for a in amounts], "amount double")
    totals = {total(frame.orderBy(F.xxhash64(F.lit(n), "amount")).repartition(n)) for n in (1, 2, 3, 7, 11)}
    exact = sum(Decimal(round(a * 100)) for a in amounts)
    assert totals == {float(exact / 100)} and exact > 2**53


def test_what_is_no_finite_amount_does_not_count(spark):
    odd = [(float("nan"),), (float("inf"),), (-math.inf,), (1e30,), (None,)]
    assert total(spark.createDataFrame([*odd, (1.0,), (2.5,)], "amount double")) == 3.5
    assert total(spark.createDataFrame(odd, "amount double")) is None


def test_to_money_rounds_half_up(spark):
    texts = ["1.005", "2.675", "10", "-1.005", "0.005", "0.004", "1e3", "x", "", None, "123456789.126", "NaN"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "a string").select(to_money("a")).collect()]
    assert got[:7] == [1.01, 2.68, 10.0, -1.01, 0.01, 0.0, 1000.0]
    assert got[7:10] == [None, None, None]
    assert got[10:12] == [123456789.13, None]


def test_ratios_are_rounded_once(spark):
    rng = random.Random(11)
    pairs = [(rng.randrange(0, 10**8), rng.randrange(1, 400)) for _ in range(3000)] + [(1, 2), (25, 2), (10050, 4)]
    df = spark.createDataFrame([(Decimal(c), n, c) for c, n in pairs], "cents decimal(38,0), n bigint, c bigint")
    for row in df.select("c", "n", money_per(F.col("cents"), F.col("n")).alias("m")).collect():
        assert row.m == float((Decimal(row.c) / 100 / row.n).quantize(Decimal("0.01"), ROUND_HALF_UP))
    assert spark.range(1).select(money_per(F.lit(Decimal(5)), F.lit(0).cast("bigint"))).first()[0] is None


def test_percent(spark):
    rng = random.Random(3)
    rows = [(Decimal(rng.randrange(0, 10**6)) / 100, Decimal(rng.randrange(1, 10**6)) / 100) for _ in range(500)]
    rows.append((Decimal("1.00"), Decimal("0.00")))
    df = spark.createDataFrame(rows, "a decimal(28,2), b decimal(28,2)")
    for row in df.select("a", "b", percent_of(F.col("a"), F.col("b")).alias("p")).collect():
        if row.b == 0:
            assert row.p is None
        else:
            assert row.p == (row.a / row.b * 100).quantize(Decimal("0.01"), ROUND_HALF_UP)
