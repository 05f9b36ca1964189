import datetime as dt
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratamill.operators.upsert import upsert
from stratamill.sinks.published import (
    current_version,
    live_directories,
    publish,
    read_published,
    replace_published,
    stage,
    stage_upsert,
    upsert_published,
)
from stratamill.sinks.replicate import replicate

KIND = "k string, v int, y int"


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def make(spark, *values):
    return spark.createDataFrame(list(values), KIND)


def test_matches_replace_and_others_stay(spark):
    target = make(spark, ("a", 1, 1), ("b", 2, 1), (None, 3, 1))
    source = make(spark, ("b", 9, 2), ("c", 4, 2), (None, 5, 2))
    merged = upsert(target, source, "k")
    assert rows(merged) == Counter([("a", 1, 1), ("b", 9, 2), ("c", 4, 2), (None, 3, 1), (None, 5, 2)])
    assert rows(upsert(merged.filter("k is not null"), source.filter("k is not null"), "k")) == rows(
        merged.filter("k is not null")
    )


def test_columns_of_one_side(spark):
    target = make(spark, ("a", 1, 1), ("b", 2, 1))
    source = spark.createDataFrame([("b", "new")], "k string, note string")
    got = {r.k: (r.v, r.note) for r in upsert(target, source, "k").collect()}
    assert got == {"a": (1, None), "b": (None, "new")}


def test_older_source_row_wins_unless_guarded(spark):
    target = make(spark, ("a", 1, 5), ("b", 1, 5), ("n", 1, None))
    source = make(spark, ("a", 2, 4), ("b", 2, 5), ("c", 2, 1), ("n", 2, 1))
    assert rows(upsert(target, source, "k"))[("a", 2, 4)] == 1
    guarded = rows(upsert(target, source, "k", order_by="y"))
    assert guarded == Counter([("a", 1, 5), ("b", 2, 5), ("c", 2, 1), ("n", 2, 1)])


@pytest.mark.parametrize("partition_by", [(), ("y",)])
def test_published_upserts_equal_the_operator(spark, folder, partition_by):
    expected = make(spark)
    for batch in (
        [("a", 1, 1), ("b", 2, 1), ("c", 3, 2), ("d", 4, None)],
        [("e", 5, 3)],
        [("a", 6, 2), ("d", 7, 1)],
        [("c", 8, 3), ("f", 9, None)],
        [("a", 6, 2), ("b", 0, 1), ("c", 8, 3), ("d", 7, 1), ("e", 5, 3), ("f", 9, None)],
    ):
        source = make(spark, *batch)
        want = rows(upsert(expected, source, "k"))
        version = upsert_published(source, folder, "k", partition_by)
        assert rows(read_published(spark, folder)) == want
        assert version == current_version(spark, folder)
        expected = spark.createDataFrame([(k, v, y) for k, v, y in want], KIND)


def test_emptied_partition_disappears(spark, folder):
    upsert_published(make(spark, ("a", 1, 1), ("b", 1, 2)), folder, "k", ("y",))
    upsert_published(make(spark, ("a", 2, 2)), folder, "k", ("y",))
    assert rows(read_published(spark, folder)) == Counter([("a", 2, 2), ("b", 1, 2)])
    assert not [d for d in live_directories(spark, folder) if d.endswith("/y=1")]


def test_untouched_partitions_are_not_rewritten(spark, folder):
    upsert_published(make(spark, ("a", 1, 1), ("b", 1, 2), ("c", 1, 3)), folder, "k", ("y",))
    before = set(live_directories(spark, folder))
    upsert_published(make(spark, ("b", 2, 2), ("d", 2, 3)), folder, "k", ("y",))
    after = set(live_directories(spark, folder))
    assert {d.split("/")[1] for d in before & after} == {"y=1", "y=3"}


def test_staged_rows_are_not_visible(spark, folder):
    upsert_published(make(spark, ("a", 1, 1)), folder, "k", ("y",))
    stage_upsert(make(spark, ("a", 2, 1), ("z", 2, 9)), folder, "k", ("y",))
    assert rows(read_published(spark, folder)) == Counter([("a", 1, 1)])


def test_empty_batch_changes_nothing(spark, folder):
    upsert_published(make(spark, ("a", 1, 1)), folder, "k", ("y",))
    upsert_published(make(spark), folder, "k", ("y",))
    assert rows(read_published(spark, folder)) == Counter([("a", 1, 1)])


def test_guarded_published_upsert(spark, folder):
    upsert_published(make(spark, ("a", 1, 5), ("b", 1, 5)), folder, "k", (), order_by="y")
    upsert_published(make(spark, ("a", 2, 4), ("b", 2, 6)), folder, "k", (), order_by="y")
    assert rows(read_published(spark, folder)) == Counter([("a", 1, 5), ("b", 2, 6)])


def test_new_columns_appear(spark, folder):
    upsert_published(make(spark, ("a", 1, 1), ("b", 1, 1)), folder, "k", ("y",))
    upsert_published(make(spark, ("b", 2, 1)).withColumn("note", F.lit("x")), folder, "k", ("y",))
    assert {r.k: (r.v, r.y, r.note) for r in read_published(spark, folder).collect()} == {"a": (1, 1, None), "b": (2, 1, "x")}


def test_date_partitions(spark, folder):
    def day(n):
        return dt.date(2024, 1, n)

    kind = "k string, d date"
    upsert_published(spark.createDataFrame([("a", day(1)), ("b", day(2)), ("n", None)], kind), folder, "k", ("d",))
    upsert_published(spark.createDataFrame([("a", day(2))], kind), folder, "k", ("d",))
    table = read_published(spark, folder)
    assert dict(table.dtypes)["d"] == "date"
    assert rows(table) == Counter([(day(2), "a"), (day(2), "b"), (None, "n")])


def test_full_refresh_replaces_the_schema(spark, folder):
    replace_published(make(spark, ("a", 1, 1)), folder)
    replace_published(spark.range(3), folder)
    assert read_published(spark, folder).columns == ["id"] and read_published(spark, folder).count() == 3


def test_missing_table(spark, folder):
    assert live_directories(spark, f"{folder}/none") == []
    with pytest.raises(FileNotFoundError):
        read_published(spark, f"{folder}/none")


def test_partition_columns_prune(spark, folder):
    upsert_published(make(spark, *[(str(i), i, i % 5) for i in range(50)]), folder, "k", ("y",))
    plan = read_published(spark, folder).filter("y = 3").select("k")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan and "ReadSchema: struct<k:string>" in plan


def test_replicas_are_copies_and_failures_stay_local(spark, folder):
    df = spark.range(10).withColumn("r", F.rand(1)).withColumn("t", F.current_timestamp())
    (open(f"{folder}/blocked", "w")).close()
    targets = {"main": f"{folder}/main", "bad": f"{folder}/blocked", "copy": f"{folder}/copy"}
    status = replicate(df, "model", targets)
    assert status["main"] == status["copy"] == "ok" and status["bad"].startswith("failed")
    assert rows(read_published(spark, f"{folder}/main/model")) == rows(read_published(spark, f"{folder}/copy/model"))
    with pytest.raises(Exception):
        replicate(df, "model", {"bad": f"{folder}/blocked", "copy": f"{folder}/copy"})


def test_publish_lists_exactly_what_it_is_given(spark, folder):
    first, second = stage(spark.range(2), folder), stage(spark.range(5), folder)
    publish(spark, folder, first)
    publish(spark, folder, [*first, *second])
    assert read_published(spark, folder).count() == 7


def test_only_the_null_partition_is_touched(spark, folder):
    upsert_published(make(spark, ("a", 1, None), ("b", 1, None)), folder, "k", ("y",))
    upsert_published(make(spark, ("a", 2, None)), folder, "k", ("y",))
    assert rows(read_published(spark, folder)) == Counter([("a", 2, None), ("b", 1, None)])
    upsert_published(make(spark, ("c", 1, 5), ("d", 1, 6)), folder, "k", ("y",))
    upsert_published(make(spark, ("b", 3, 5)), folder, "k", ("y",))
    table = read_published(spark, folder)
    assert dict(table.dtypes)["y"] == "int"
    assert rows(table) == Counter([("a", 2, None), ("b", 3, 5), ("c", 1, 5), ("d", 1, 6)])


def half_written(folder, number):
    """What a crash leaves of a version: a directory without a finished file."""
    path = Path(folder) / "published" / f"version={number}" / "_temporary" / "0"
    path.mkdir(parents=True)
    (path / "part-00000").write_text("snapshot=lost")


def test_a_half_written_version_is_in_nobodys_way(spark, folder, tmp_path):
    rows_in = spark.createDataFrame([("a", 1)], "k string, v int")
    half_written(folder, 1)
    assert current_version(spark, folder) == 0
    assert replace_published(rows_in, folder) == 1
    half_written(folder, 2)
    assert current_version(spark, folder) == 1
    assert upsert_published(spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int"), folder, "k") == 2
    assert replace_published(read_published(spark, folder), folder) == 3
    assert {tuple(r) for r in read_published(spark, folder).collect()} == {("a", 2), ("b", 3)}
    half_written(str(tmp_path), 1)
    assert set(replicate(read_published(spark, folder), "copy", {"t": str(tmp_path)}).values()) == {"ok"}
