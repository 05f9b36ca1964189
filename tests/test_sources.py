import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from stratamill.contracts import CUSTOMERS, TRANSACTIONS
from stratamill.operators.lineage import stamp
from stratamill.sinks.published import replace_published
from stratamill.sources.bronze import append_bronze, read_all_bronze, read_bronze
from stratamill.sources.files import read_files, read_new_files, utc_text
from stratamill.sources.serving import as_table, as_view, serve


def put(folder, name, text, modified=None):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    if modified is not None:
        os.utime(path, (modified, modified))
    return str(path)


def test_csv_is_text_unless_types_are_inferred(spark, folder):
    put(folder, "c.csv", "customer_id,country_code,email\n1, us ,A@X\n2,gb,\n")
    as_text = read_files(spark, folder)
    assert dict(as_text.dtypes)["customer_id"] == "string"
    assert {tuple(r) for r in as_text.collect()} == {("1", " us ", "A@X"), ("2", "gb", None)}
    assert dict(read_files(spark, folder, infer_types=True).dtypes)["customer_id"] == "int"


def test_csv_header_in_another_order_is_not_read_by_position(spark, folder):
    one = put(folder, "1.csv", "a,b\n1,2\n")
    other = put(folder, "2.csv", "b,a\n3,4\n")
    assert read_files(spark, one).first().asDict() == {"a": "1", "b": "2"}
    assert read_files(spark, other).first().asDict() == {"b": "3", "a": "4"}
    with pytest.raises(Exception):
        read_files(spark, [one, other]).collect()


def test_json_and_parquet(spark, folder):
    put(folder, "j/p.json", '{"product_id": "p1", "price": 2.5}\n{"product_id": "p2", "category": "x"}\n')
    rows = {tuple(r) for r in read_files(spark, f"{folder}/j", "json").select("product_id", "price", "category").collect()}
    assert rows == {("p1", 2.5, None), ("p2", None, "x")}
    typed = read_files(spark, f"{folder}/j", "json", schema="product_id string, price string")
    assert {tuple(r) for r in typed.collect()} == {("p1", "2.5"), ("p2", None)}
    spark.range(4).write.parquet(f"{folder}/q")
    assert read_files(spark, [f"{folder}/q"], "parquet").count() == 4


def test_format_dispatch(spark, folder):
    spark.range(2).write.orc(f"{folder}/o")
    with pytest.raises(ValueError):
        read_files(spark, f"{folder}/o", "orc")
    assert read_files(spark, f"{folder}/o", "orc", formats=None).count() == 2


def test_only_files_modified_strictly_later(spark, folder):
    moment = 1_700_000_000
    for name, modified in (("old", moment - 1), ("same", moment), ("new", moment + 1)):
        put(folder, f"{name}.csv", f"id\n{name}\n", modified)
    since = dt.datetime.fromtimestamp(moment, dt.timezone.utc)

    def read(**options):
        frame = read_new_files(spark, folder, "csv", **options)
        return None if frame is None else {r.id for r in frame.collect()}

    assert read(since=since) == {"new"}
    assert read(since=since.replace(tzinfo=None)) == {"new"}
    assert read() == {"old", "same", "new"}
    assert read(since=since + dt.timedelta(days=1)) is None
    assert utc_text(dt.datetime(2024, 1, 1, 2, tzinfo=dt.timezone(dt.timedelta(hours=2)))).startswith("2024-01-01T00:00")


def test_no_feed_is_none_but_a_broken_one_raises(spark, folder):
    assert read_new_files(spark, f"{folder}/none", "parquet") is None
    put(folder, "x/broken.parquet", "this is not parquet")
    with pytest.raises(Exception):
        read_new_files(spark, f"{folder}/x", "parquet")


def test_bronze_append_takes_new_columns(spark, folder):
    first = dt.datetime(2024, 1, 1, 3)
    append_bronze(stamp(spark.createDataFrame([("a",)], "k string"), "s", "aws", run_ts=first), folder)
    later = spark.createDataFrame([("b", 1)], "k string, extra int")
    append_bronze(stamp(later, "s", "aws", run_ts=first + dt.timedelta(days=1)), folder)
    table = read_bronze(spark, folder)
    assert {(r.k, r.extra, r._date_part) for r in table.collect()} == {
        ("a", None, dt.date(2024, 1, 1)),
        ("b", 1, dt.date(2024, 1, 2)),
    }
    assert read_bronze(spark, folder, "k string, extra int, _date_part date").count() == 2
    assert sorted(p.name for p in Path(folder).glob("_date_part=*")) == ["_date_part=2024-01-01", "_date_part=2024-01-02"]


def test_missing_sources_are_skipped(spark, folder):
    for cloud, ids in (("aws", "int"), ("gcp", "string")):
        frame = spark.createDataFrame([(1,)], "customer_id int").selectExpr(f"cast(customer_id as {ids}) customer_id")
        append_bronze(stamp(frame, "s", cloud), f"{folder}/{cloud}")
    places = {c: f"{folder}/{c}" for c in ("aws", "azure", "gcp")}
    table = read_all_bronze(spark, places, CUSTOMERS)
    assert {r._cloud for r in table.collect()} == {"aws", "gcp"}
    assert dict(table.dtypes)["customer_id"] == "string"
    with pytest.raises(RuntimeError):
        read_all_bronze(spark, {"azure": f"{folder}/azure"}, TRANSACTIONS)


def test_unreadable_source_raises(spark, folder):
    put(folder, "aws/_date_part=2024-01-01/part.parquet", "garbage")
    with pytest.raises(Exception) as error:
        read_all_bronze(spark, {"aws": f"{folder}/aws"}, CUSTOMERS).collect()
    assert not isinstance(error.value, RuntimeError)


def test_serving(spark, folder):
    replace_published(spark.createDataFrame([("toys", 5.0), ("food", 7.0)], "category string, revenue double"), folder)
    serve(spark, folder, "served_revenue")
    rows = spark.sql("SELECT category FROM served_revenue ORDER BY revenue DESC").collect()
    assert [r.category for r in rows] == ["food", "toys"]
    as_view(spark.range(3), "three_ids")
    assert spark.table("three_ids").count() == 3
    as_table(spark.range(4), "four_ids")
    as_table(spark.range(5), "four_ids")
    assert spark.table("four_ids").count() == 5
    spark.sql("DROP TABLE four_ids")


def test_a_view_over_a_missing_table_raises(spark, folder):
    with pytest.raises((FileNotFoundError, AnalysisException)):
        serve(spark, f"{folder}/none", "nothing")
