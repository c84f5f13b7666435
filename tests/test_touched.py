"""Upserts that rewrite only the files holding changed keys."""

import random
from datetime import date
from pathlib import Path

import pytest

from feedfold.sources import sinks, tables, touched
from feedfold.streaming import feeds

SCHEMA = "id int, v string, n int, day date"


def _rows(n):
    return [(i, f"v{i}", i, date(2024, 1, 1 + i % 2)) for i in range(n)]


def _files(path):
    return {str(p): p.read_bytes() for p in Path(path).rglob("*.parquet")}


def _values(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("id", "v", "n", "day").collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "a b%20c")  # scans escape such names
    first = spark.createDataFrame(_rows(400), SCHEMA)
    touched.upsert_touched(first, path, "day", ["id"], ["n"], spread=8, small_bytes=0)
    return path


def test_only_files_with_changed_keys_are_rewritten(spark, table, tmp_path):
    before, rng = _files(table), random.Random(1)
    assert len(before) > 10
    some = rng.sample(_rows(400), 2)
    delta = [(i, None, n + 1, d) for i, _, n, d in some] + [(i, "x", 0, d) for i, _, _, d in some[:1]] + [(9000, "new", 1, date(2024, 1, 2)), (9001, "day", 1, date(2024, 1, 9))]
    frame = spark.createDataFrame(delta, SCHEMA)
    plain = str(tmp_path / "plain")
    sinks.replace_partitions(spark.createDataFrame(_rows(400), SCHEMA), plain, ["day"])
    feeds.upsert_partitions(frame, plain, "day", ["id"], ["n"])
    for again in range(2):
        report = touched.upsert_touched(frame, table, "day", ["id"], ["n"], small_bytes=0)
        after = _files(table)
        same = [p for p in before if after.get(p) == before[p]]
        assert 1 <= len(report.rewritten) <= 5 and report.kept
        assert len(same) >= len(before) - 2
        assert _values(spark, table) == _values(spark, plain)


def test_small_files_are_taken_along_and_types_are_kept_alike(spark, table):
    report = touched.upsert_touched(spark.createDataFrame([(3, "z", 9, date(2024, 1, 2))], SCHEMA), table, "day", ["id"], ["n"])
    assert not report.kept and len(_files(f"{table}/day=2024-01-02")) == 1 and len(_files(f"{table}/day=2024-01-01")) > 4
    # a column turns to text: all files of the day are written anew, so that one folder holds one type
    text = spark.createDataFrame([(3, "z", "many", date(2024, 1, 1))], "id int, v string, n string, day date")
    report = touched.upsert_touched(text, table, "day", ["id"], ["n"], small_bytes=0)
    assert not report.kept
    found = {r["id"]: r["n"] for r in tables.read_partitions(spark, table, "day", [date(2024, 1, 1), date(2024, 1, 2)]).collect()}
    assert found[3] in ("many", "9") and found[4] == "4" and len(found) == 400


def test_undated_rows_and_no_rows_change_nothing(spark, table):
    before = _files(table)
    empty = spark.createDataFrame([(1, "x", 5, None)], SCHEMA)
    assert touched.upsert_touched(empty, table, "day", ["id"], ["n"], small_bytes=0) == touched.FileReport([], [])
    assert _files(table) == before
