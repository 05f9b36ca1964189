"""Upserts look keys up in files and rewrite the files that hold them, not whole directories."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratamill.operators.upsert import upsert
from stratamill.plans.maintenance import LayoutTask, cluster_table, compact_table
from stratamill.session import setting
from stratamill.sinks import published
from stratamill.sinks.published import (
    LOOKUP_KEYS,
    files_holding,
    is_file,
    list_files,
    live_directories,
    publish,
    read_directories,
    read_published,
    stage,
    upsert_published,
)
from stratamill.sinks.replicate import replicate_directories

KIND = "k string, v int, y int"


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def live_files(spark, root):
    return {r.file for r in list_files(spark, root, live_directories(spark, root)).collect()}


def spread_table(spark, root, n=800, files=8):
    """Every file holds keys of the whole range, so that minima and maxima tell nothing."""
    frame = spark.range(n).selectExpr("sha1(cast(id as string)) as k", "cast(id as int) as v", "cast(id % 2 as int) as y")
    publish(spark, root, stage(frame.repartition(files, "k"), root, ("y",), rebalance=False, lookup="k"))


def test_a_correction_rewrites_one_file(spark, folder):
    spread_table(spark, folder)
    before = live_files(spark, folder)
    assert len(before) == 16
    row = read_published(spark, folder).filter("v = 7").first()
    upsert_published(spark.createDataFrame([(row.k, -7, 0), ("new", 1, 1)], KIND), folder, "k", ("y",))
    after = live_files(spark, folder)
    assert len(before - after) == 1 and len(before & after) == 15
    table = read_published(spark, folder)
    assert table.count() == 801 and table.filter("k = 'new' or v = -7").count() == 2 and table.filter("v = 7").count() == 0
    assert {d.split("/")[1] for d in live_directories(spark, folder) if is_file(d)} == {"y=1"}


@pytest.mark.parametrize("order_by", [None, "v"])
def test_many_batches_equal_the_operator(spark, folder, monkeypatch, order_by):
    rng = random.Random(5)
    monkeypatch.setattr(published, "LOOKUP_KEYS", 6)  # batches on both sides of it
    spread_table(spark, folder, n=60, files=4)
    expected = read_published(spark, folder).collect()
    known = [r.k for r in expected]
    for size in (3, 12, 1, 25, 6):
        keys = rng.sample(known, size - 1) + [f"new{size}"]
        batch = [(k, rng.randrange(60), rng.choice([0, 1, 2, None])) for k in keys]
        source = spark.createDataFrame(batch, KIND)
        want = rows(upsert(spark.createDataFrame([(r.k, r.v, r.y) for r in expected], KIND), source, "k", order_by))
        upsert_published(source, folder, "k", ("y",), order_by)
        expected = read_published(spark, folder).collect()
        assert rows(read_published(spark, folder)) == want


def test_null_keys_are_in_no_file(spark, folder):
    publish(spark, folder, stage(spark.createDataFrame([(None, 1, 1), ("a", 2, 1)], KIND), folder, lookup="k"))
    nulls = spark.createDataFrame([(None, 3, 1)], KIND)
    assert files_holding(read_published(spark, folder), nulls, "k") == []
    assert files_holding(read_published(spark, folder), nulls.limit(0), "k") == []


def scanned_rows(df):
    """Rows that the scan of a plan without exchanges hands over."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    scans = [node for node in _nodes(plan) if "numOutputRows" in node.metrics().keys().mkString(",") and "Scan" in node.nodeName()]
    return scans[0].metrics().apply("numOutputRows").value()


def _nodes(plan):
    leaves = plan.collectLeaves()
    return [leaves.apply(i) for i in range(leaves.size())]


def test_bloom_filters_skip_files_without_the_keys(spark, folder):
    n, files = 200_000, 20
    frame = spark.range(n).selectExpr("sha1(cast(id as string)) as k", "id as v").repartition(files, "k")
    publish(spark, folder, stage(frame, folder, lookup="k"))
    table = read_published(spark, folder).select("k")
    path = table.select("_metadata.file_path").first()[0]
    held = [r.k for r in read_published(spark, folder).filter(F.col("_metadata.file_path") == path).limit(LOOKUP_KEYS).collect()]
    absent = [r.k for r in spark.range(n, n + LOOKUP_KEYS).selectExpr("sha1(cast(id as string)) as k").collect()]
    with setting(spark, "spark.sql.parquet.pushdown.inFilterThreshold", LOOKUP_KEYS):
        assert scanned_rows(table.filter(F.col("k").isin(absent))) == 0
        assert 0 < scanned_rows(table.filter(F.col("k").isin(held))) <= 2 * n / files
    batch = spark.createDataFrame([(k,) for k in held], "k string")
    assert files_holding(read_published(spark, folder), batch, "k") == ["snapshot=" + path.split("snapshot=")[1]]


def test_keys_in_order_bound_the_search(spark, folder):
    frame = spark.range(20_000).selectExpr("id as k", "id as v").repartitionByRange(10, "k")
    publish(spark, folder, stage(frame, folder, lookup="k"))
    table = read_published(spark, folder)
    late = spark.range(18_500, 22_000).selectExpr("id as k")
    assert late.count() > LOOKUP_KEYS
    assert len(files_holding(table, late, "k")) <= 2
    assert files_holding(table, spark.range(20_000, 22_000).selectExpr("id as k"), "k") == []
    assert scanned_rows(table.filter(F.col("k").between(18_500, 21_999))) <= 2 * 2_200


def test_an_old_batch_rewrites_nothing(spark, folder):
    spread_table(spark, folder, n=40, files=2)
    before = live_files(spark, folder)
    row = read_published(spark, folder).filter("v = 7").first()
    upsert_published(spark.createDataFrame([(row.k, 1, 0)], KIND), folder, "k", ("y",), order_by="v")
    assert before <= live_files(spark, folder) and read_published(spark, folder).filter("v = 7").count() == 1


def test_layout_of_partitions_with_single_files(spark, folder):
    spread_table(spark, folder)
    rows_before = rows(read_published(spark, folder))
    task = LayoutTask("t", folder, ("v",), ("y",), "k")
    size = sum(r.length for r in list_files(spark, folder, live_directories(spark, folder)).collect()) // 8
    assert cluster_table(spark, task, file_bytes=size) == 2
    row = read_published(spark, folder).filter("v = 7").first()
    upsert_published(spark.createDataFrame([(row.k, -7, 1)], KIND), folder, "k", ("y",))
    listed = live_directories(spark, folder)
    assert any(map(is_file, listed))
    with pytest.raises(ValueError, match="single files"):
        replicate_directories(spark, "t", listed, {"main": folder})
    assert cluster_table(spark, task, file_bytes=size, loose_share=1.0) == 0
    assert live_directories(spark, folder) == listed
    want = rows_before - Counter([(row.k, 7, 1)]) + Counter([(row.k, -7, 1)])
    assert rows(read_published(spark, folder)) == want
    assert cluster_table(spark, task, file_bytes=size, loose_share=0.0) > 2
    assert len(live_directories(spark, folder)) == 2 and rows(read_published(spark, folder)) == want
    upsert_published(spark.createDataFrame([(row.k, 8, 0)], KIND), folder, "k", ("y",))
    assert compact_table(spark, LayoutTask("t", folder, (), ("y",), "k")) > 0
    assert not any(map(is_file, live_directories(spark, folder)))
    assert rows(read_published(spark, folder)) == want - Counter([(row.k, -7, 1)]) + Counter([(row.k, 8, 0)])
