"""Data-quality checks. Each yields rows ``model, check, column_name, violations, status``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratamill.functions.days import RunTime, micros_between, run_time


@dataclass(frozen=True)
class RowRule:
    """A rule a single row can break."""

    check: str
    column: str
    broken: Column


def not_null(column: str) -> RowRule:
    """The value is present."""
    return RowRule("not_null", column, F.col(column).isNull())


def in_range(column: str, low: float | None = None, high: float | None = None) -> RowRule:
    """The value lies between the bounds, both included; NULL passes."""
    broken = F.lit(False)
    if low is not None:
        broken = broken | (F.col(column) < F.lit(low))
    if high is not None:
        broken = broken | (F.col(column) > F.lit(high))
    return RowRule("accepted_range", column, broken)


def one_of(column: str, values: Sequence[str]) -> RowRule:
    """The value is in the list; NULL passes."""
    return RowRule("accepted_values", column, ~F.col(column).isin(*values))


def castable(column: str, kind: str) -> RowRule:
    """The raw value fits the type; NULL passes."""
    return RowRule(f"type_{kind}", column, F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull())


def contract_rules(df: DataFrame, columns: dict[str, str]) -> list[RowRule]:
    """One rule per contract column; a column the frame lacks is broken in every row."""
    return [
        castable(name, kind) if name in df.columns else RowRule(f"type_{kind}", name, F.lit(True))
        for name, kind in columns.items()
    ]


def _status(violations: Column) -> Column:
    return F.when(violations == 0, "pass").otherwise("fail")


def profile(df: DataFrame, model: str, rules: Sequence[RowRule]) -> DataFrame:
    """All row rules of a model in one pass over its rows."""
    counted = df.agg(*[F.count_if(rule.broken).alias(f"v{i}") for i, rule in enumerate(rules)])
    lines = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(rule.check).alias("check"),
            F.lit(rule.column).alias("column_name"),
            F.col(f"v{i}").alias("violations"),
            _status(F.col(f"v{i}")).alias("status"),
        )
        for i, rule in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*lines)))


REPORT = "model string, check string, column_name string, violations bigint, status string"


class Observed:
    """Row rules counted, and totals taken, while an action runs over a model's ``rows``.

    No pass of its own is needed. Results are there after the first action over ``rows``;
    asking earlier waits for it.
    """

    def __init__(self, df: DataFrame, model: str, rules: Sequence[RowRule] = (), **totals: Column):
        self.model, self.rules, self._spark = model, list(rules), df.sparkSession
        self._observation = Observation()
        counts = [F.count_if(rule.broken).alias(f"v{i}") for i, rule in enumerate(self.rules)]
        metrics = [*counts, *[value.alias(name) for name, value in totals.items()]]
        self.rows = df.observe(self._observation, *metrics) if metrics else df

    def total(self, name: str) -> int | None:
        """A total; None over no rows."""
        return self._observation.get.get(name)

    def report(self) -> DataFrame:
        """A line per rule, as :func:`profile` gives."""
        counts = [self.total(f"v{i}") or 0 for i in range(len(self.rules))]
        return report(self._spark, self.model, [(r.check, r.column, n) for r, n in zip(self.rules, counts, strict=True)])


def report(spark: SparkSession, model: str, lines: Sequence[tuple[str, str, int]]) -> DataFrame:
    """Report lines from check, column and violations."""
    rows = [(model, check, column, n, "pass" if n == 0 else "fail") for check, column, n in lines]
    return spark.createDataFrame(rows, REPORT)


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their row counts."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """No non-null value repeats; counts the values that do."""
    counted = repeated_values(df, column).agg(F.count(F.lit(1)).alias("violations"))
    return counted.select(
        F.lit(model).alias("model"),
        F.lit("unique").alias("check"),
        F.lit(column).alias("column_name"),
        "violations",
        _status(F.col("violations")).alias("status"),
    )


def freshness(
    df: DataFrame,
    model: str,
    loaded_at: str,
    as_of: RunTime = None,
    warn_hours: int = 6,
    error_hours: int = 24,
) -> DataFrame:
    """Age of the newest row against the two limits; a table without rows is an error."""
    newest = df.agg(F.max(loaded_at).alias("newest"))
    age = micros_between(F.col("newest"), run_time(as_of))
    hour = 3_600_000_000
    return newest.select(
        F.lit(model).alias("model"),
        F.lit(loaded_at).alias("loaded_at"),
        "newest",
        age.alias("age_us"),
        F.when(age.isNull() | (age > error_hours * hour), "error")
        .when(age > warn_hours * hour, "warn")
        .otherwise("pass")
        .alias("status"),
    )


def parity(
    df: DataFrame,
    model: str,
    expected: Sequence[str],
    source: str = "_cloud",
    tolerance: float = 0.05,
) -> DataFrame:
    """Row counts of the expected sources lie within ``tolerance`` of the greatest.

    A source without rows counts as 0. One row is returned per check, and no
    rows at all is a failure.
    """
    counted = df.agg(*[F.count_if(F.col(source) == name).alias(name) for name in expected])
    least = F.least(*[F.col(name) for name in expected]) if len(expected) > 1 else F.col(expected[0])
    most = F.greatest(*[F.col(name) for name in expected]) if len(expected) > 1 else F.col(expected[0])
    gap = F.try_divide((most - least).cast("double"), most.cast("double"))
    return counted.select(
        F.lit(model).alias("model"),
        least.alias("least_rows"),
        most.alias("most_rows"),
        gap.alias("gap"),
        F.when(gap <= tolerance, "pass").otherwise("fail").alias("status"),
    )


def conservation(aggregated: DataFrame, units: str, rows: DataFrame) -> DataFrame:
    """The units of an aggregate add up to the rows it was built from: no join multiplied them."""
    no_count = F.lit(0).cast("bigint")
    totals = aggregated.agg(F.sum(units).alias("total_units")).select(
        F.coalesce("total_units", no_count).alias("total_units"), no_count.alias("n_rows")
    )
    counts = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(no_count.alias("total_units"), "n_rows")
    both = totals.unionByName(counts).agg(F.sum("total_units").alias("total_units"), F.sum("n_rows").alias("n_rows"))
    return both.withColumn("status", F.when(F.col("total_units") == F.col("n_rows"), "pass").otherwise("fail"))
