from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratamill.functions.zcurve import bucket_of, interleave, quantile_bounds
from stratamill.operators.layout import cluster, compact, target_file_bytes
from stratamill.plans.maintenance import LayoutTask, _batches, cluster_table, compact_table, maintain
from stratamill.sinks.published import current_version, list_files, live_directories, publish, read_published, stage, upsert_published


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def spans(df, column):
    """Share of the table's value range that an average file covers, weighted by rows."""
    ranked = df.select(F.col("_metadata.file_path").alias("f"), F.dense_rank().over(_by(column)).alias("r"))
    low, high = ranked.agg(F.min("r"), F.max("r")).first()
    per_file = ranked.groupBy("f").agg((F.max("r") - F.min("r")).alias("w"), F.count("*").alias("n"))
    weight, count = per_file.agg(F.sum(F.col("w") * F.col("n")), F.sum("n")).first()
    return weight / count / (high - low)


def _by(column):
    from pyspark.sql import Window

    return Window.orderBy(column)


def test_buckets_count_the_bounds_at_or_below(spark):
    bounds = [3, 7, 7.5, 20]
    df = spark.createDataFrame([(v,) for v in [None, -1.0, 3.0, 6.9, 7.0, 7.5, 19.0, 20.0, 99.0]], "v double")
    got = [r[0] for r in df.select(bucket_of(F.col("v"), bounds)).collect()]
    assert got == [0, 0, 1, 1, 2, 3, 3, 4, 4]
    assert [r[0] for r in df.select(bucket_of(F.col("v"), [])).distinct().collect()] == [0]
    assert quantile_bounds([1] * 10 + [2], 4) == [1] and quantile_bounds([None], 4) == []
    assert quantile_bounds(range(100), 4) == [25, 50, 75]


def test_interleaved_bits(spark):
    row = spark.range(1).select(interleave([F.lit(0b101).cast("bigint"), F.lit(0b011).cast("bigint")], 3)).first()
    assert row[0] == 0b011011
    with pytest.raises(ValueError):
        interleave([F.lit(0)] * 8, 8)


def test_cluster_keeps_rows_and_rejects_partition_columns(spark):
    df = spark.range(500).selectExpr("cast(id % 37 as string) a", "id % 11 b", "if(id % 5 = 0, null, id) c", "id % 2 p")
    for columns in (["a"], ["a", "c"], ["b", "a", "c"]):
        assert rows(cluster(df, columns, files=5)) == rows(df)
    assert rows(cluster(df, ["a", "c"], files=5, partition_by=["p"])) == rows(df)
    assert rows(cluster(df.limit(0), ["a", "c"])) == Counter()
    with pytest.raises(ValueError):
        cluster(df, ["a", "p"], partition_by=["p"])
    with pytest.raises(ValueError):
        cluster(df, [])


def test_z_order_narrows_both_columns(spark, folder):
    df = spark.range(20_000).select(
        F.concat(F.lit("customer-"), F.lpad((F.xxhash64("id") % 1000 + 1000).cast("string"), 5, "0")).alias("customer_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.abs(F.xxhash64(F.col("id") + 7)) % 1000).cast("int")).alias("txn_date"),
    )
    publish(spark, folder, stage(df.repartition(16), folder))
    before = {c: spans(read_published(spark, folder), c) for c in df.columns}
    assert min(before.values()) > 0.95
    files = list_files(spark, folder, live_directories(spark, folder))
    size = files.agg(F.sum("length")).first()[0] // 16
    cluster_table(spark, LayoutTask("t", folder, ("customer_id", "txn_date")), file_bytes=size)
    table = read_published(spark, folder)
    assert rows(table) == rows(df)
    assert max(spans(table, c) for c in df.columns) < 0.5


def test_hot_value_is_spread_over_files(spark, folder):
    same = spark.range(9000).selectExpr("'hot' as k", "1 as v")
    other = spark.range(18000).selectExpr("concat('k', id) as k", "2 as v")
    publish(spark, folder, stage(same.union(other).repartition(4), folder))
    size = list_files(spark, folder, live_directories(spark, folder)).agg(F.sum("length")).first()[0] // 9
    cluster_table(spark, LayoutTask("t", folder, ("k",)), file_bytes=size)
    table = read_published(spark, folder)
    per_file = table.groupBy("_metadata.file_path").agg(F.count("*").alias("n"), F.count_if(F.col("k") == "hot").alias("hot"))
    largest = per_file.agg(F.max("n"), F.count_if(F.col("hot") > 0)).first()
    assert largest[0] < 27000 / 9 * 2 and largest[1] >= 3
    assert table.count() == 27000


def test_compaction_rewrites_only_fragmented_partitions(spark, folder):
    df = spark.range(3000).selectExpr("id", "id % 3 as p")
    many = stage(df.filter("p < 2").repartition(12), folder, ("p",), rebalance=False)
    single = stage(df.filter("p = 2").coalesce(1), folder, ("p",), rebalance=False)
    publish(spark, folder, [*many, *single])
    before = list_files(spark, folder, live_directories(spark, folder)).count()
    assert compact_table(spark, LayoutTask("t", folder, (), ("p",))) == 2
    after = live_directories(spark, folder)
    assert set(single) <= set(after)
    assert before == 25 and list_files(spark, folder, after).count() == 3
    assert rows(read_published(spark, folder)) == rows(df)
    assert compact_table(spark, LayoutTask("t", folder, (), ("p",))) == 0


def test_compaction_operator_and_target_size(spark, folder):
    df = spark.range(400_000).selectExpr("id", "uuid() as u").repartition(40)
    with target_file_bytes(spark, 4 * 1024 * 1024):
        compact(df).write.parquet(f"{folder}/out")
    sizes = [r.length for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{folder}/out").select("length").collect()]
    assert 2 <= len(sizes) < 40
    default = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert "4194304" not in default


def test_sweep_goes_on_after_a_failure(spark, folder):
    for name in ("a", "c"):
        publish(spark, f"{folder}/{name}", stage(spark.range(100).repartition(5), f"{folder}/{name}"))
    tasks = [LayoutTask("a", f"{folder}/a"), LayoutTask("bad", f"{folder}/none", ("id",)), LayoutTask("c", f"{folder}/c", ("id",))]
    with pytest.raises(RuntimeError, match="bad"):
        maintain(spark, tasks)
    for name in ("a", "c"):
        assert list_files(spark, f"{folder}/{name}", live_directories(spark, f"{folder}/{name}")).count() == 1
    assert maintain(spark, tasks[::2]) == {"a": 0, "c": 0}


def test_only_changed_partitions_are_clustered_again(spark, folder):
    kind = "k string, v int, p int"
    frame = spark.createDataFrame([(f"k{i}", i, i % 3) for i in range(90)], kind)
    upsert_published(frame, folder, "k", ("p",))
    task = LayoutTask("t", folder, ("k", "v"), ("p",))
    assert cluster_table(spark, task) == 3 and cluster_table(spark, task) == 0
    upsert_published(spark.createDataFrame([("k0", -1, 0), ("new", 7, 1)], kind), folder, "k", ("p",))
    changed = [d for d in live_directories(spark, folder) if d.endswith(("p=0", "p=1"))]
    assert cluster_table(spark, task) == len(changed) == 4
    assert len(live_directories(spark, folder)) == 3
    table = {r.k: r.v for r in read_published(spark, folder).collect()}
    assert len(table) == 91 and table["k0"] == -1 and table["new"] == 7
    assert cluster_table(spark, LayoutTask("t", folder, ("v",), ("p",))) == 3


def test_clustering_in_batches(spark, folder):
    frame = spark.createDataFrame([(f"k{i}", i, i % 4) for i in range(400)], "k string, v int, p int")
    upsert_published(frame, folder, "k", ("p",))
    before = current_version(spark, folder)
    assert cluster_table(spark, LayoutTask("t", folder, ("k", "v"), ("p",)), batch_bytes=1) == 4
    assert current_version(spark, folder) == before + 4
    assert rows(read_published(spark, folder)) == rows(frame)
    assert [sorted(b) for b in _batches({"snapshot=a/p=1": 5, "snapshot=b/p=1": 5, "snapshot=a/p=2": 3, "snapshot=a/p=3": 4}, 8, 100)] == [
        ["snapshot=a/p=1", "snapshot=b/p=1"], ["snapshot=a/p=2", "snapshot=a/p=3"]
    ]
