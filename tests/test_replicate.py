"""Copies by difference."""

from pathlib import Path

import pytest

from stratamill.sinks import replicate
from stratamill.sinks.published import current_version, live_directories, publish, read_published, stage, upsert_published
from stratamill.sinks.replicate import repair, replicate_directories


@pytest.fixture
def targets(folder):
    return {"main": f"{folder}/main", "copy": f"{folder}/copy"}


@pytest.fixture
def copied(monkeypatch):
    """The directories that were written to a copy, call by call."""
    calls = []
    real = replicate._copy
    monkeypatch.setattr(replicate, "_copy", lambda *args, **kw: (calls.append(sorted(args[3])), real(*args, **kw)))
    return calls


def table(spark, n, month="2"):
    return spark.range(n).selectExpr("id", "id * 0.1D AS v", f"cast(nullif(id % {month}, 1) AS int) AS month")


def rows(spark, root):
    return sorted(map(str, read_published(spark, f"{root}/t").collect()))


def test_second_run_copies_nothing(spark, targets, copied):
    directories = stage(table(spark, 10, "3"), f"{targets['main']}/t", ["month"])
    assert len(directories) == 3
    for _ in range(2):
        assert replicate_directories(spark, "t", directories, targets) == {"main": "ok", "copy": "ok"}
    assert copied == [directories]
    assert rows(spark, targets["copy"]) == rows(spark, targets["main"])
    assert [current_version(spark, f"{root}/t") for root in targets.values()] == [1, 1]


def test_only_changed_directories_are_copied(spark, targets, copied):
    root = f"{targets['main']}/t"
    replicate_directories(spark, "t", stage(table(spark, 10), root, ["month"]), targets)
    upsert_published(spark.createDataFrame([(0, 9.0, 7)], "id long, v double, month int"), root, "id", ["month"])
    live = live_directories(spark, root)
    replicate_directories(spark, "t", live, targets)
    assert len(live) == 3 and len(copied[1]) == 2  # the month that lost the row, and its new one
    assert rows(spark, targets["copy"]) == rows(spark, targets["main"])
    assert sorted(live_directories(spark, f"{targets['copy']}/t")) == live


@pytest.mark.parametrize("harm", ["cut", "gone", "changed"])
def test_a_broken_copy_is_found_and_mended(spark, targets, copied, harm):
    directories = stage(table(spark, 10), f"{targets['main']}/t", ["month"])
    replicate_directories(spark, "t", directories, targets)
    broken = Path(targets["copy"], "t", directories[0])
    file = next(broken.glob("*.parquet"))
    if harm == "cut":
        file.write_bytes(file.read_bytes()[:50])
    elif harm == "gone":
        file.write_bytes(b"")
    else:
        spark.createDataFrame([(0, 5.0)], "id long, v double").coalesce(1).write.mode("append").parquet(str(broken))
    for checksum in broken.glob(".*.crc"):
        checksum.write_bytes(b"")
    assert repair(spark, "t", targets) == {"main": "ok", "copy": "ok"}
    assert directories[0] in copied[1]
    assert rows(spark, targets["copy"]) == rows(spark, targets["main"])


def test_a_copy_that_fails_keeps_the_old_one_and_is_gone_on_with(spark, targets, monkeypatch):
    root = f"{targets['main']}/t"
    replicate_directories(spark, "t", stage(table(spark, 4), root, ["month"]), targets)
    before = rows(spark, targets["copy"])
    later = stage(table(spark, 9), root, ["month"])
    real = replicate.checksums

    def wrong(session, where, *args, **kw):
        return {d: n + ("copy" in where) for d, n in real(session, where, *args, **kw).items()}

    with monkeypatch.context() as patch:
        patch.setattr(replicate, "checksums", wrong)
        assert replicate_directories(spark, "t", later, targets) == {"main": "ok", "copy": "failed: OSError"}
    assert rows(spark, targets["copy"]) == before
    assert replicate_directories(spark, "t", later, targets)["copy"] == "ok"
    assert rows(spark, targets["copy"]) == rows(spark, targets["main"])


def test_checksums_do_not_depend_on_order_or_files(spark, folder):
    frame = table(spark, 50)
    found = set()
    for n, rows_in in enumerate((frame, frame.orderBy("v", ascending=False).coalesce(1), frame.repartition(7))):
        root = f"{folder}/{n}"
        (directory,) = stage(rows_in, root)
        publish(spark, root, [directory])
        found |= set(replicate.checksums(spark, root, [directory]).values())
    assert len(found) == 1
    (other,) = stage(frame.where("id > 0"), f"{folder}/other")
    assert replicate.checksums(spark, f"{folder}/other", [other])[other] not in found
