import os
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from stratamill.sources import batches
from stratamill.streaming.ingest import ingest_available


def run(spark, folder, fmt="parquet", **options):
    return ingest_available(
        spark, f"{folder}/raw", f"{folder}/bronze", f"{folder}/checkpoint", fmt, source="feed", cloud="gcp", **options
    )


def bronze(spark, folder):
    return spark.read.parquet(f"{folder}/bronze")


def test_each_file_enters_once(spark, folder):
    assert run(spark, folder) is False
    spark.range(5).write.parquet(f"{folder}/raw")
    assert run(spark, folder) and bronze(spark, folder).count() == 5
    assert run(spark, folder) and bronze(spark, folder).count() == 5
    spark.range(5, 8).write.mode("append").parquet(f"{folder}/raw")
    run(spark, folder, max_files_per_batch=1)
    table = bronze(spark, folder)
    assert sorted(r.id for r in table.collect()) == list(range(8))
    assert table.select("_source", "_layer", "_cloud").distinct().collect() == [("feed", "bronze", "gcp")]
    assert "_date_part" in table.columns and "_ingested_at" in table.columns


def test_events_in_parts(spark, folder):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    views, others = events.filter("event_type = 'view'"), events.filter("event_type <> 'view'")
    views.write.parquet(f"{folder}/raw")
    run(spark, folder)
    others.write.mode("append").parquet(f"{folder}/raw")
    run(spark, folder)
    got = bronze(spark, folder).select(*events.columns)
    assert got.exceptAll(events).count() == 0 and events.exceptAll(got).count() == 0


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_text_feeds(spark, folder, fmt):
    frame = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string")
    frame.write.option("header", True).format(fmt).save(f"{folder}/raw")
    run(spark, folder, fmt)
    assert {(r.id, r.name) for r in bronze(spark, folder).collect()} == {("1", "a"), ("2", "b")}


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_columns_that_come_later_arrive(spark, folder, fmt):
    for n in range(4):
        rows = spark.range(n * 10, n * 10 + 3).selectExpr("id", f"concat('v', id) as extra_{n}")
        rows.coalesce(1).write.mode("append").format(fmt).save(f"{folder}/raw")
        assert run(spark, folder, fmt)
    table = spark.read.option("mergeSchema", True).parquet(f"{folder}/bronze")
    got = {int(r.id): [r[f"extra_{n}"] for n in range(4)] for r in table.collect()}
    assert got == {n * 10 + k: [f"v{n * 10 + k}" if m == n else None for m in range(4)] for n in range(4) for k in range(3)}


def test_columns_that_only_one_of_many_new_files_has_arrive(spark, folder):
    for n in range(5):
        spark.range(n, n + 1).selectExpr("id", f"id as only_{n}").write.mode("append").parquet(f"{folder}/raw")
    run(spark, folder)
    table = spark.read.option("mergeSchema", True).parquet(f"{folder}/bronze")
    assert all(table.filter(f"only_{n} = {n}").count() == 1 for n in range(5))


def test_csv_headers_that_change_are_read_by_name(spark, folder):
    raw = Path(folder, "raw")
    raw.mkdir()
    feeds = [
        "id,name\n1,a\n",
        "id,more,name\n2,b,c\n",
        "NAME,last,id\n\"x,y\",z,3\n",
        "more,id\n4,id\nmore,id\n",
    ]
    for n, text in enumerate(feeds):
        (raw / f"odd [{n}] %20.csv").write_text(text)
        assert run(spark, folder, "csv") and run(spark, folder, "csv")
    (raw / "empty.csv").write_text("")
    (raw / "header only.csv").write_text("id,later\n")
    assert run(spark, folder, "csv")
    (raw / "two.csv").write_text("later,id\nl,5\n")
    assert run(spark, folder, "csv")
    table = spark.read.option("mergeSchema", True).parquet(f"{folder}/bronze")
    got = sorted((r.id, r.name, r.more, r.last, r.later) for r in table.collect())
    assert got == [
        ("1", "a", None, None, None), ("2", "c", "b", None, None), ("3", "x,y", None, "z", None),
        ("5", None, None, None, "l"), ("id", None, "4", None, None), ("id", None, "more", None, None),
    ]


def test_csv_headers_of_one_batch(spark, folder):
    raw = Path(folder, "raw", "day=a")
    raw.mkdir(parents=True)
    for n in range(6):
        (raw / f"{n}.csv").write_text(f"id,extra_{n % 3}\n" + "".join(f"{n}{k},v{n}\n" for k in range(3)))
    assert run(spark, folder, "csv", max_files_per_batch=4)
    table = spark.read.option("mergeSchema", True).parquet(f"{folder}/bronze")
    got = {r.id: (r.day, [r[f"extra_{k}"] for k in range(3)]) for r in table.collect()}
    assert got == {f"{n}{k}": ("a", [f"v{n}" if m == n % 3 else None for m in range(3)]) for n in range(6) for k in range(3)}


def test_given_schema_picks_columns_by_name(spark, folder):
    raw = Path(folder, "raw")
    raw.mkdir()
    (raw / "1.csv").write_text("b,a\n2,1\n")
    (raw / "2.csv").write_text("a,c\n3,x\n")
    assert run(spark, folder, "csv", schema="a int, b int")
    assert sorted((r.a, r.b) for r in bronze(spark, folder).collect()) == [(1, 2), (3, None)]


def test_a_crash_before_the_list_repeats_nothing(spark, folder, monkeypatch):
    """Rows of the dead attempt lie there; the next run takes the same files again and lists them once."""
    spark.range(5).write.parquet(f"{folder}/raw")

    def dies(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as patch:
        patch.setattr(batches, "publish", dies)
        with pytest.raises(StreamingQueryException):
            run(spark, folder)
    assert batches.live_batches(spark, f"{folder}/bronze") == []
    assert run(spark, folder)
    (live,) = batches.live_batches(spark, f"{folder}/bronze")
    assert batches.read_batches(spark, f"{folder}/bronze", [live]).count() == 5
    # A batch whose list was written before its checkpoint is not added again.
    rows = batches.read_batches(spark, f"{folder}/bronze", [live])
    assert batches.add_batch(rows, f"{folder}/bronze", live.split("/")[0].rsplit("-", 1)[1]) is False


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_columns_of_a_late_file_with_an_old_time_arrive(spark, folder, fmt):
    spark.range(3).coalesce(1).write.format(fmt).save(f"{folder}/raw")
    assert run(spark, folder, fmt)
    late = spark.range(3, 5).selectExpr("id", "concat('v', id) AS extra").coalesce(1)
    late.write.format(fmt).save(f"{folder}/late")
    (part,) = Path(folder, "late").glob("part-*")
    old = Path(folder, "raw", f"odd [name] {part.name}")
    part.rename(old)
    day_before = old.stat().st_mtime - 86_400
    os.utime(old, (day_before, day_before))
    assert run(spark, folder, fmt) and run(spark, folder, fmt)
    table = spark.read.option("mergeSchema", True).parquet(f"{folder}/bronze")
    assert {(int(r.id), r.extra) for r in table.collect()} == {*((i, None) for i in range(3)), (3, "v3"), (4, "v4")}


def test_columns_in_folder_names_arrive_with_new_files(spark, folder):
    for day in ("a", "b"):
        frame = spark.range(2).selectExpr("id", f"'{day}' AS day", f"id AS only_{day}")
        frame.write.mode("append").partitionBy("day").parquet(f"{folder}/raw")
        run(spark, folder)
    table = spark.read.option("mergeSchema", True).parquet(f"{folder}/bronze")
    assert sorted((r.day, r.only_a, r.only_b) for r in table.collect() if r.id == 1) == [("a", 1, None), ("b", None, 1)]
