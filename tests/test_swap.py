"""Exchanges that a lost driver breaks off, bucketed snapshots, and writers in each other's way."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from feedfold.operators import merge
from feedfold.plans import jobs
from feedfold.sources import sinks, swap, tables
from feedfold.sources.files import Store

ROWS = [(i, "old", date(2024, 1, 1 + i % 3)) for i in range(30)]


class Lost(BaseException):
    """The driver goes."""


def _table(spark, path):
    sinks.replace_partitions(spark.createDataFrame(ROWS, "id int, v string, day date"), path, ["day"])


def _new(spark):
    return spark.createDataFrame([(i, "new", d) for i, _, d in ROWS if d.day > 1], "id int, v string, day date")


def _values(spark, path):
    return sorted((r["id"], r["v"]) for r in spark.read.parquet(path).collect())


OLD = [(i, "old") for i, _, _ in ROWS]
NEW = [(i, "new" if d.day > 1 else "old") for i, _, d in ROWS]


@pytest.mark.parametrize("step", range(0, 9))
def test_a_lost_driver_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, step):
    """The driver is lost before each change to the file system in turn; the next run finds all old or makes all new."""
    path = str(tmp_path / "t")
    _table(spark, path)
    count = {"n": 0}

    def lose(method):
        def run(self, *args):
            if count["n"] == step:
                raise Lost
            count["n"] += 1
            return method(self, *args)

        return run

    with monkeypatch.context() as m:
        for name in ("write_new", "remove", "move"):
            m.setattr(Store, name, lose(getattr(Store, name)))
        # a driver that is lost clears nothing up
        m.setattr(swap, "_clear", lambda *a: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            sinks.replace_partitions(_new(spark), path, ["day"], owner="run 1")
    assert len(_values(spark, path)) <= 30
    swap.settle(spark, path, owner="run 1")
    assert _values(spark, path) in (OLD, NEW)
    assert not Store(spark, path).names(f"{path}/_swap")
    sinks.replace_partitions(_new(spark), path, ["day"], owner="run 1")
    assert _values(spark, path) == NEW


def test_a_second_writer_is_refused_until_the_lease_runs_out(spark, tmp_path):
    path = str(tmp_path / "t")
    _table(spark, path)

    def write(staged):
        _new(spark).write.partitionBy("day").parquet(staged)
        with pytest.raises(swap.TableBusy):
            sinks.replace_partitions(_new(spark), path, ["day"])
        return swap.Exchange()

    swap.swap(spark, path, write)
    assert _values(spark, path) == OLD

    def taken(staged):  # so slow that its lease ran out and another run took over
        swap.settle(spark, path, now=9e12)
        sinks.replace_partitions(_new(spark), path, ["day"])
        return swap.Exchange(removes=[f"{path}/day=2024-01-01"])

    with pytest.raises(swap.TableBusy):
        swap.swap(spark, path, taken)
    assert _values(spark, path) == NEW


def test_a_failed_write_lets_go_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    _table(spark, path)
    bad = spark.createDataFrame(ROWS, "id int, v string, day date").withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        sinks.replace_partitions(bad, path, ["day"])
    _table(spark, path)
    assert _values(spark, path) == OLD


def test_snapshot_remembers_its_layout(spark, tmp_path):
    base = str(tmp_path / "snap")
    rows = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("odd name"), F.struct(F.lit(1).alias("a b")).alias("s"))
    sinks.write_snapshot(sinks.cluster_by(rows, 8, ["k"]), base, "2024-01-01", keys=["k"], buckets=8)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("feedfold_")]
    history = tables.latest_snapshot(spark, base, "2024-01-02")
    assert history.columns == rows.columns and history.count() == 1000
    delta = spark.range(0, 2000, 2).select(F.concat(F.lit("k"), "id").alias("k"), (-F.col("id")).alias("odd name"))
    merged = merge.snapshot_merge(history, delta, ["k"], ["odd name"], clusters=8, laid_out=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    scan = next(part for part in plan.split("\n") if "FileScan" in part)
    assert "Bucketed: true" in scan
    # every exchange stands over the delta, none over the scan of history
    assert all("FileScan" not in part for part in plan.split("Exchange hashpartitioning")[1:])
    sinks.write_snapshot(merged, base, "2024-01-02", keys=["k"], buckets=8)
    files = [f for f in Store(spark, base).names(f"{base}/snapshot_date=2024-01-02") if f.endswith(".parquet")]
    assert len(files) == 8
    back = tables.latest_snapshot(spark, base, "2024-01-03")
    assert back.count() == 1500 and back.where("`odd name` < 0").count() == 999 and back.where("s is null").count() == 1000
    # a day written again is exchanged as a whole
    sinks.write_snapshot(rows.limit(5), base, "2024-01-02")
    assert tables.latest_snapshot(spark, base, "2024-01-03").count() == 5


def test_merge_blogs_shuffles_the_delta_only(spark, tmp_path, monkeypatch):
    blogs, snaps = str(tmp_path / "blogs"), str(tmp_path / "snaps")
    rows = spark.range(200).select(F.concat(F.lit("h"), "id").alias("UrlHash"), F.col("id").alias("Key"), F.current_timestamp().alias("CurrentTimestamp"), F.lit(0).alias("kafkapartition"), F.col("id").alias("kafkaoffset"))
    sinks.write_delta(rows, blogs, "2024-01-01", "01-00")
    sinks.write_delta(rows.where("id < 20").withColumn("Fresh", F.lit(True)), blogs, "2024-01-02", "01-00")
    jobs.merge_blogs(spark, "2024-01-01", blogs, snaps, clusters=6)
    plans = []
    write = sinks.write_snapshot
    monkeypatch.setattr(sinks, "write_snapshot", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a, **k)))
    jobs.merge_blogs(spark, "2024-01-02", blogs, snaps)
    assert "Bucketed: true" in plans[0]
    assert all("snapshot_date" not in part for part in plans[0].split("Exchange hashpartitioning")[1:])
    merged = tables.latest_snapshot(spark, snaps, "2024-01-03")
    assert merged.count() == 200 and merged.where("Fresh").count() == 20
    assert tables.layout_of(spark, f"{snaps}/snapshot_date=2024-01-02")["buckets"] == 6
