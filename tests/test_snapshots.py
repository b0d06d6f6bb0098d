"""Snapshot files as a table and as a stream: numbering, pruning, types, missing columns."""

from __future__ import annotations

import pytest

from plumbline.sources import readers
from plumbline.sources.snapshots import SnapshotReader, listed, read_snapshots, stream_snapshots

SCHEMA = "id bigint, name string, price double"


@pytest.fixture
def folder(tmp_path):
    for day, rows in ((2, "5,e,2.5\n"), (1, "1,a,1.5\n2,NA,\n"), (10, '7,"x, y",3\n8,"two\nlines",oops\n')):
        (tmp_path / f"daily_{day:02d}.csv").write_text(f"id,name,price\n{rows}")
    (tmp_path / "daily_03.csv").write_text("name,id,more\nf,6,z\n")
    (tmp_path / "other.csv").write_text("id,name,price\n99,n,1\n")
    (tmp_path / "_hidden_04.csv").write_text("broken")
    return tmp_path


def test_numbers_types_and_missing_columns(spark, folder):
    df = read_snapshots(spark, f"{folder}/daily_*.csv", SCHEMA)
    rows = {(r["day"], r["id"], r["name"], r["price"]) for r in df.collect()}
    assert rows == {
        (1, 1, "a", 1.5), (1, 2, None, None), (2, 5, "e", 2.5), (3, 6, "f", None), (4, 7, "x, y", 3.0), (4, 8, "two\nlines", None),
    }
    assert dict(df.dtypes) == {"id": "bigint", "name": "string", "price": "double", "day": "bigint"}


def test_types_are_found_in_all_files(spark, folder):
    df = read_snapshots(spark, f"file://{folder}/daily_0[12].csv", snapshot="n")
    assert dict(df.dtypes) == {"id": "int", "name": "string", "price": "double", "n": "bigint"}
    assert df.where("n = 2").first()["price"] == 2.5


def test_numbers_equal_those_of_the_plain_scan(spark, folder):
    plain = readers.scan_snapshots(spark, f"{folder}/daily_0[12].csv").select("day", "id")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, read_snapshots(spark, f"{folder}/daily_0[12].csv", "id int").select("day", "id").collect()))


@pytest.mark.parametrize(
    ("condition", "days"),
    [("day = 3", {3}), ("day BETWEEN 2 AND 3", {2, 3}), ("day IN (1, 4)", {1, 4}), ("day > 3 AND name IS NOT NULL", {4}), ("day <=> 2", {2}), ("day < 0", set()), ("day * day = 4", {1, 2, 3, 4})],
)
def test_a_condition_opens_only_its_files(spark, folder, condition, days):
    """The number of tasks is the number of opened files; broken files outside the condition do no harm."""
    broken = {1: "daily_01", 2: "daily_02", 3: "daily_03", 4: "daily_10"}
    for day, name in broken.items():
        if day not in days:
            (folder / f"{name}.csv").write_bytes(b"\xff\xfe")
    df = read_snapshots(spark, f"{folder}/daily_*.csv", SCHEMA).where(condition)
    assert df.rdd.getNumPartitions() == max(1, len(days))
    assert {r["day"] for r in df.collect()} == ({2} if "*" in condition else days)


def test_conditions_on_other_columns_stay_with_spark(folder):
    from pyspark.sql.datasource import EqualTo, IsNotNull, Not

    reader = SnapshotReader(f"{folder}/daily_*.csv", None, "day", {})
    filters = [EqualTo(("name",), "a"), EqualTo(("day",), 1), IsNotNull(("day",)), Not(EqualTo(("day",), 2))]
    assert list(reader.pushFilters(filters)) == [filters[0], filters[3]]
    assert [f.day for f in reader.partitions()] == [1]


def test_listing(folder):
    assert [f.rsplit("/", 1)[1] for f in listed(str(folder))] == ["daily_01.csv", "daily_02.csv", "daily_03.csv", "daily_10.csv", "other.csv"]
    assert listed(f"{folder}/nothing/*.csv") == [] and len(listed(f"{folder}/other.csv")) == 1
    (folder / "y=1").mkdir()
    (folder / "y=1" / "daily_11.csv").write_text("id\n1\n")
    assert [f.rsplit("/", 1)[1] for f in listed(f"{folder}/y=*/daily_*.csv")] == ["daily_11.csv"]
    assert len(listed(f"{folder}/daily_*.csv")) == 4


def test_no_files(spark, tmp_path):
    assert read_snapshots(spark, f"{tmp_path}/*.csv", SCHEMA).count() == 0
    with pytest.raises(Exception, match="no snapshot files"):
        read_snapshots(spark, f"{tmp_path}/*.csv")


def test_new_files_are_new_snapshots(spark, folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))

    def run():
        stream = stream_snapshots(spark, f"{folder}/daily_*.csv", SCHEMA)
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/cp").trigger(availableNow=True).start(f"{out}/rows")
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted((r["day"], r["id"]) for r in spark.read.parquet(f"{out}/rows").collect())

    first = run()
    assert first == [(1, 1), (1, 2), (2, 5), (3, 6), (4, 7), (4, 8)] and run() == first
    (folder / "daily_11.csv").write_text("id,name,price\n9,z,1\n")
    (folder / "daily_12.csv").write_text("id,name,price\n10,z,1\n")
    assert run() == [*first, (5, 9), (6, 10)]
