import threading

import pytest
from pyspark.sql import functions as F

from tidemark.sinks.versions import KeyedTable, VersionedTable, WriteConflict

SCHEMA = "k string, at int, v string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def files(df):
    return set(df.inputFiles())


def test_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path, rows):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", buckets=8)
    table.replace(frame(spark, *[(f"k{i}", 1, "old") for i in range(60)]))
    before = files(table.read())
    table.upsert(frame(spark, ("k3", 1, "x"), ("k3", 2, "new"), ("k3", 2, "mew"), (None, 1, "n"), (None, 1, "n")), ["at"])
    after = files(table.read())
    got = {r.k: r.v for r in table.read().filter("k is not null").collect()}
    assert len(got) == 60 and got.pop("k3") == "new" and set(got.values()) == {"old"}
    assert table.read().filter("k is null").count() == 2
    assert len(before & after) >= len(before) - 2 and before - after
    table.upsert(frame(spark, ("k4", 0, "older wins too"), ("z", 1, "added")), ["at"])
    assert {r.k: r.v for r in table.read().collect()}["k4"] == "older wins too"
    assert table.read().count() == 63 and table.latest().number == 3


def test_a_failed_write_leaves_the_old_version(spark, tmp_path, rows):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    table.replace(frame(spark, ("a", 1, "x"), ("b", 1, "y")))
    want = rows(table.read())
    broken = frame(spark, ("a", 2, "z")).withColumn("v", F.when(F.col("at") == 2, F.raise_error(F.lit("no"))).otherwise("v"))
    with pytest.raises(Exception, match="no"):
        table.upsert(broken, ["at"])
    assert rows(table.read()) == want and table.latest().number == 1
    table.upsert(frame(spark, ("a", 2, "z")), ["at"])
    assert rows(table.read()) == [("a", 2, "z"), ("b", 1, "y")]


def test_one_of_two_writers_wins(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    df = frame(spark, ("a", 1, "x"))
    base = table.commit(None, {"p": table.put(df, "p")}, df.schema)
    outcomes, folder = [], table.put(df, "q")

    def write(name):
        try:
            VersionedTable(spark, table.path).commit(base, {name: folder}, df.schema)
            outcomes.append("done")
        except WriteConflict:
            outcomes.append("conflict")

    threads = [threading.Thread(target=write, args=(n,)) for n in "xy"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(outcomes) == ["conflict", "done"]
    with pytest.raises(WriteConflict):
        table.commit(base, {"z": folder}, df.schema)


def test_old_versions_stay_readable_until_vacuum(spark, tmp_path, rows):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", buckets=2, split={"big": F.col("at") > 5})
    table.replace(frame(spark, ("a", 1, "x"), ("b", 9, "y"), (None, 9, "n")))
    for i in range(3):
        table.upsert(frame(spark, ("a", 7 + i, f"x{i}")), ["at"])
    assert rows(table.read(version=1)) == rows(frame(spark, ("a", 1, "x"), ("b", 9, "y"), (None, 9, "n")))
    assert rows(table.with_value("big", "true")) == rows(frame(spark, ("a", 9, "x2"), ("b", 9, "y"), (None, 9, "n")))
    assert table.with_value("big", "false").count() == 0
    newest = files(table.read())
    assert table.vacuum(keep_versions=1) > 0
    assert files(table.read()) == newest and table.read().count() == 3
    assert table.vacuum(keep_versions=1) == 0


def test_keep_newest_equals_one_pass_over_all(spark, tmp_path, rows):
    from tidemark.operators.clean import latest_per_key

    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=3)
    days = [[(f"k{(i * d) % 7}", (i * 5 + d) % 11, f"v{i}") for i in range(20)] + [(None, d, "n")] for d in (1, 2, 3)]
    for day in days:
        table.keep_newest(frame(spark, *day), ["at"])
    assert rows(table.read()) == rows(latest_per_key(frame(spark, *sum(days, [])), "k", "at"))


def test_empty_frames(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k")
    with pytest.raises(FileNotFoundError):
        table.read()
    table.upsert(frame(spark, ("a", 1, "x")).limit(0), ["at"])
    assert table.read().count() == 0 and table.read().columns == ["k", "at", "v"]
    table.upsert(frame(spark, ("a", 1, "x")), ["at"])
    table.upsert(frame(spark, ("a", 1, "x")).limit(0), ["at"])
    assert table.read().count() == 1


def test_keep_newest_reduces_once(spark, tmp_path, rows):
    """The landing rows are stored as they come; stored and landing rows are reduced by one shuffle."""
    table = KeyedTable(spark, str(tmp_path / "t"), "k", buckets=2)
    first = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "n"), (None, 1, "n")]
    table.keep_newest(frame(spark, *first), ["at"])
    landing = spark.read.parquet(str(tmp_path / "t" / "data" / "landing-*"))
    assert rows(landing) == rows(frame(spark, *first))
    table.keep_newest(frame(spark, ("a", 1, "late"), ("b", 2, "w"), ("b", 3, "v"), (None, 1, "n")), ["at"])
    assert rows(table.read()) == [("a", 2, "y"), ("b", 3, "v"), *[(None, 1, "n")] * 3]
