"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its share of the wanted total over its own size. Each
document draws its number of copies by inverting a Poisson distribution of that mean
at a uniform value hashed from the seed and its id, is exploded by it, and every copy
gets a hashed place in a global shuffle. A rerun draws the same copies. Where an id, or
its lack, stands on several rows, their text and a running number of equal rows are
hashed with it, so that each draws for itself.

Sizes are summed on the map side. The rates are joined by a key of the weight table,
so what is broadcast has a row per weight at most, however many sources the data has.
The shuffle is keyed by a hash per copy: a hot source or repeated document is spread.
Repeated ids are counted on the map side; only their rows are written once more, and
equal rows are numbered within the task that read them, behind those of the tasks before.

Defined cases: sources without a weight of their own, the null source included, share
the rest's weight as one group. A null text counts as empty. A group without any character keeps its documents once.
Empty tables give an empty result. Extra columns are carried along; the result's own two
columns replace any of the same name. A weight that would take more than ``MAX_RATE``
copies of each document raises an error.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratamill.sinks.written import written_once

MAX_WEIGHTS = 10_000
MAX_RATE = 10_000.0
BROADCAST_IDS = 100_000
# 52 bits of a digest make the uniform value, so that it is exact in a double.
_HEX_DIGITS = 13


def uniform(*parts: Column) -> Column:
    """A value in (0, 1) that depends on the parts alone."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    digits = F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("double")
    return (digits + 0.5) / float(16**_HEX_DIGITS)


def _group(source: Column, weights: Mapping[str, float]) -> Column:
    return F.when(source.isin(*weights), source) if weights else F.lit(None).cast("string")


def repetition_rates(
    df: DataFrame, weights: Mapping[str, float], rest: float, epochs: float, source: str, text: str
) -> DataFrame:
    """Group (null: the rest) and ``rate``, the mean number of copies of its documents."""
    spark = df.sparkSession
    sizes = df.groupBy(_group(F.col(source), weights).alias("_group")).agg(
        F.sum(F.coalesce(F.length(text), F.lit(0))).alias("size")
    )
    given = spark.createDataFrame(
        [*[(k, float(w)) for k, w in weights.items()], (None, float(rest))],
        T.StructType([T.StructField("_g", T.StringType()), T.StructField("weight", T.DoubleType())]),
    )
    whole = Window.partitionBy(F.lit(0))
    present = sizes.join(F.broadcast(given), F.col("_group").eqNullSafe(F.col("_g")))
    wanted = F.col("weight") / F.sum("weight").over(whole) * F.sum("size").over(whole) * epochs
    rate = F.coalesce(F.try_divide(wanted, F.col("size")), F.lit(1.0))
    too_rare = F.raise_error(F.lit(f"a source is too small for its weight: more than {MAX_RATE:.0f} copies each"))
    return present.select("_group", F.when(rate > MAX_RATE, too_rare.cast("double")).otherwise(rate).alias("rate"))


def poisson_steps(rates: DataFrame) -> DataFrame:
    """``_group``, ``rate`` and ``steps``: the distribution function at 0, 1, 2, ... as far as it is below 1.

    Beyond ``rate + 9 sqrt(rate) + 40`` the rest of the distribution is under 2^-53.
    """
    rate = F.col("rate")
    last = F.ceil(rate + 9 * F.sqrt(rate) + 40).cast("int")
    by_group = Window.partitionBy("_group").orderBy("k")
    points = rates.select("_group", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    log_factorial = F.sum(F.when(F.col("k") > 0, F.log(F.col("k").cast("double"))).otherwise(0.0)).over(by_group)
    mass = F.when(rate == 0, F.when(F.col("k") == 0, 1.0).otherwise(0.0)).otherwise(
        F.exp(F.col("k") * F.log(rate) - rate - F.col("log_factorial"))
    )
    points = points.withColumn("log_factorial", log_factorial).withColumn("mass", mass)
    points = points.withColumn("step", F.sum("mass").over(by_group))
    steps = F.transform(F.sort_array(F.collect_list(F.struct("k", "step"))), lambda p: p["step"])
    return points.groupBy("_group", "rate").agg(steps.alias("steps"))


def identified(rows: DataFrame, text: Column) -> DataFrame:
    """``_row``, ``_key``, ``_group`` and ``_ident``: the key, with more behind it where several rows have the key."""
    key = F.coalesce(F.col("_key").cast("string"), F.lit("null"))
    columns = ["_row", "_key", "_group"]
    repeated = written_once(rows.groupBy("_key").count().where(F.col("count") > 1).select(F.col("_key").alias("_id")))
    n_repeated = repeated.count()
    if n_repeated == 0:
        return rows.select(*columns, key.alias("_ident"))
    without = repeated.where("_id is null").count() > 0
    ids = repeated.where("_id is not null").withColumn("_repeated", F.lit(True))
    ids = F.broadcast(ids) if n_repeated <= BROADCAST_IDS else ids
    known = rows.where("_key is not null").join(ids, F.col("_key") == F.col("_id"), "left")
    known = known.select(*columns, F.coalesce("_repeated", F.lit(False)).alias("_repeated"))
    told = known.union(rows.where("_key is null").select(*columns, F.lit(without).alias("_repeated")))

    text_mark = F.coalesce(F.md5(text), F.lit("null"))
    mark = F.md5(F.concat_ws(":", key, text_mark, F.coalesce(F.md5("_group"), F.lit("null"))))
    alike = told.where("_repeated").select(*columns, mark.alias("_mark"), F.spark_partition_id().alias("_task"))
    alike = written_once(alike)
    counts = alike.groupBy("_mark", "_task").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_mark").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_mark", "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_mark", "_task").orderBy("_mark"))
    numbered = alike.withColumn("_own", own).join(counts, ["_mark", "_task"])
    ident = F.concat_ws(":", key, F.col("_mark"), F.col("_before") + F.col("_own"))
    single = told.where("not _repeated").select(*columns, key.alias("_ident"))
    return single.union(numbered.select(*columns, ident.alias("_ident")))


def mix(
    df: DataFrame,
    weights: Mapping[str, float],
    rest: float = 1.0,
    epochs: float = 1.0,
    seed: int = 0,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The columns of ``df``, ``copy`` (from 0) and ``place`` (the order of the global shuffle).

    ``weights`` are relative, by source; all other sources share ``rest``. The mixture
    holds ``epochs`` times the characters of ``df``, in expectation.
    """
    if len(weights) > MAX_WEIGHTS:
        raise ValueError(f"more than {MAX_WEIGHTS} weights")
    if min([rest, *weights.values()]) < 0 or sum([rest, *weights.values()]) <= 0:
        raise ValueError("weights must not be negative, and not all zero")
    steps = poisson_steps(repetition_rates(df, weights, rest, epochs, source, text))
    rows = df.select(
        F.struct(*df.columns).alias("_row"),
        F.col(key).alias("_key"),
        _group(F.col(source), weights).alias("_group"),
    )
    rows = identified(rows, F.col("_row")[text]).withColumn("_u", uniform(F.lit(seed), F.col("_ident")))
    # At most a row per weight, each as long as its rate: bounded by the parameters.
    drawn = rows.join(F.broadcast(steps.withColumnRenamed("_group", "_g")), F.col("_group").eqNullSafe(F.col("_g")))
    copies = F.size(F.filter("steps", lambda step: step < F.col("_u")))
    exploded = drawn.where(copies > 0).select(
        "_row", "_key", "_ident", F.explode(F.sequence(F.lit(0), copies - 1)).alias("_copy")
    )
    placed = exploded.withColumn("_place", uniform(F.lit(seed), F.col("_ident"), F.col("_copy"), F.lit("place")))
    shuffled = placed.repartition(F.col("_place")).sortWithinPartitions("_place", "_key", "_copy")
    own = [F.col("_copy").alias("copy"), F.col("_place").alias("place")]
    return shuffled.select(*[F.col("_row")[c].alias(c) for c in df.columns if c not in ("copy", "place")], *own)
