"""Feeds, offsets, readers and writers."""

import json
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.operators.offsets import EARLIEST, LEDGER_SCHEMA, next_offsets, run_offsets, starting_offsets
from feedfold.operators.schema import same_type
from feedfold.session import shared_dir
from feedfold.sources import kafka, sinks, synth, tables

FEED = kafka.Feed("broker:9092", "Posts", "readers")


def ledger(spark, rows):
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


# --- offsets ----------------------------------------------------------------

def test_run_offsets(spark):
    df = spark.createDataFrame([(0, 5), (0, 9), (1, 2)], "kafkapartition int, kafkaoffset bigint")
    rows = {r["kafkapartition"]: r for r in run_offsets(df, "Posts", "readers", "2024-01-01", "10-30").collect()}
    assert rows[0]["latestoffset"] == 9 and rows[1]["execdate"] == "2024-01-01"
    assert run_offsets(df, "t", "g", "d", "t").columns == LEDGER_SCHEMA.fieldNames()


def test_idle_partition_keeps_its_offset_and_latest_run_wins(spark):
    rows = [
        (0, 5, "Posts", "readers", "2024-01-01", "10-30"),
        (1, 7, "Posts", "readers", "2024-01-01", "10-30"),
        (0, 3, "Posts", "readers", "2024-01-02", "01-00"),
        (0, 8, "Other", "readers", "2024-01-03", "01-00"),
    ]
    got = {(r["topic"], r["kafkapartition"]): r["nextoffset"] for r in next_offsets(ledger(spark, rows)).collect()}
    assert got == {("Posts", 0): 4, ("Posts", 1): 8, ("Other", 0): 9}
    starting, first = kafka.feed_start(ledger(spark, rows), FEED, partitions=range(3))
    assert not first and json.loads(starting) == {"Posts": {"0": 4, "1": 8, "2": EARLIEST}}


def test_first_run_is_decided_by_rows_not_failures(spark):
    assert kafka.feed_start(None, FEED) == ("earliest", True)
    assert kafka.feed_start(ledger(spark, []), FEED) == ("earliest", True)
    foreign = ledger(spark, [(0, 5, "Posts", "others", "2024-01-01", "10-30")])
    assert kafka.feed_start(foreign, FEED) == ("earliest", True)


def test_bad_offsets_raise():
    with pytest.raises(ValueError):
        starting_offsets({}, "t")
    with pytest.raises(ValueError):
        starting_offsets({0: -1}, "t")


def test_reader_options():
    batch = kafka.feed_options(FEED)
    assert batch["startingOffsets"] == "earliest" and batch["endingOffsets"] == "latest"
    assert batch["failOnDataLoss"] == "false" and batch["subscribe"] == "Posts" and batch["kafka.group.id"] == "readers"
    assert "endingOffsets" not in kafka.feed_options(FEED, batch=False)


def test_missing_connector_is_an_error_not_a_first_run(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.resume_feed(spark, FEED, None)


# --- readers ----------------------------------------------------------------

def test_only_a_missing_or_empty_path_reads_as_nothing(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert tables.read_optional(spark, str(tmp_path / "nope")) is None
    (tmp_path / "empty").mkdir()
    assert tables.read_optional(spark, str(tmp_path / "empty")) is None
    assert tables.read_or_empty(spark, str(tmp_path / "nope"), schema).count() == 0
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "t"))
    assert tuple(tables.read_or_empty(spark, str(tmp_path / "t"), schema).first()) == (1, None)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        tables.read_optional(spark, str(tmp_path / "bad")).collect()
    with pytest.raises(AnalysisException):
        tables.read_optional(spark, str(tmp_path / "t")).select("zzz")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_formats(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "id bigint, day date")
    sinks.replace_partitions(df, path, ["day"], fmt=fmt)
    got = tables.read_partitions(spark, path, "day", [date(2024, 1, 2), date(2024, 1, 3)], fmt)
    assert [r["id"] for r in got.collect()] == [2]
    assert tables.read_table(spark, path, fmt).count() == 2


def test_delta_reads_one_day_and_replays_replace(spark, tmp_path):
    base = str(tmp_path / "delta")
    one = spark.createDataFrame([(1, "x")], "id int, v string")
    sinks.write_delta(one, base, "2024-01-01", "10-00")
    sinks.write_delta(one, base, "2024-01-01", "10-00")
    sinks.write_delta(spark.createDataFrame([(2, 5.0)], "id int, extra double"), base, "2024-01-01", "11-00")
    sinks.write_delta(one, base, "2024-01-02", "10-00")
    day = tables.read_delta(spark, base, "20240101")
    assert sorted(r["id"] for r in day.collect()) == [1, 2] and {"v", "extra"} <= set(day.columns)
    files = day.inputFiles()
    assert len({f.rpartition("/")[0] for f in files}) == 2 and all("exec_date=2024-01-01" in f for f in files)
    assert tables.read_delta(spark, base, "2024-03-01") is None


def test_delta_with_clashing_types_is_widened(spark, tmp_path):
    base = str(tmp_path / "delta")
    sinks.write_delta(spark.createDataFrame([(1, 5)], "id int, v bigint"), base, "2024-01-01", "10-00")
    sinks.write_delta(spark.createDataFrame([(2, "x")], "id int, v string"), base, "2024-01-01", "11-00")
    got = {r["id"]: r["v"] for r in tables.read_delta(spark, base, "2024-01-01").collect()}
    assert got == {1: "5", 2: "x"}


def test_latest_snapshot_is_the_newest_older_one(spark, tmp_path):
    base = str(tmp_path / "snap")
    assert tables.latest_snapshot(spark, base, "2024-01-01") is None
    for day, v in (("2024-01-01", 1), ("2024-01-03", 3), ("2024-01-04", 4)):
        sinks.write_snapshot(spark.createDataFrame([(v,)], "v int"), base, day)
    assert tables.latest_snapshot(spark, base, "2024-01-04").first()["v"] == 3
    assert tables.latest_snapshot(spark, base, "2024-01-01") is None


def test_replacing_leaves_other_partitions_alone_and_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    sinks.replace_partitions(df, path, ["p"])
    own = spark.read.parquet(path).where("p = 'b'").withColumn("id", F.col("id") + 10)
    sinks.replace_partitions(own, path, ["p"], max_records=1)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (12, "b")]


def test_clustered_layout(spark, tmp_path):
    df = sinks.cluster_by(spark.range(1000).withColumnRenamed("id", "k"), 7, ["k"])
    sinks.write_snapshot(df, str(tmp_path), "2024-01-01")
    back = spark.read.parquet(str(tmp_path))
    assert len(back.inputFiles()) == 7


def test_ledger_round_trip_and_replay(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert sinks.read_ledger(spark, path) is None
    rows = ledger(spark, [(0, 5, "Posts", "readers", "2024-01-01", "10-30"), (1, 6, "Posts", "readers", "2024-01-01", "10-30")])
    sinks.append_ledger(rows, path)
    sinks.append_ledger(rows, path)
    sinks.append_ledger(ledger(spark, [(0, 9, "Posts", "readers", "2024-01-02", "10-30")]), path)
    back = sinks.read_ledger(spark, path)
    assert back.count() == 3 and back.schema == LEDGER_SCHEMA
    starting, first = kafka.feed_start(back, FEED)
    assert json.loads(starting) == {"Posts": {"0": 10, "1": 7}} and not first


def test_staging_reads_only_needed_columns(spark, tmp_path):
    staged = sinks.stage(spark.createDataFrame([(1, "x")], "id int, v string"), str(tmp_path / "s"))
    plan = staged.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:int>" in plan


def test_shared_dir_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


# --- JSON and synthetic rows ------------------------------------------------

def test_json_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, ("x", None))], "id int, s struct<a:string,b:int>")
    assert json.loads(sinks.as_json(df).first()["value"]) == {"id": 1, "s": {"a": "x", "b": None}}
    sinks.save_json(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).count() == 1


def test_default_rows(spark):
    schema = T.StructType.fromDDL(
        "s string, i int, l bigint, d double, f float, b boolean, t timestamp, day date, "
        "a array<struct<x:string,y:array<bigint>>>, st struct<n:int,m:struct<q:boolean>>, bin binary"
    )
    df = synth.default_rows(spark, schema, 3)
    assert df.count() == 3 and same_type(df.schema, schema)
    row = df.first().asDict(recursive=True)
    assert (row["s"], row["i"], row["d"], row["b"], row["bin"]) == ("", 0, 0.0, False, None)
    assert row["a"] == [{"x": "", "y": [0]}] and row["st"] == {"n": 0, "m": {"q": False}}
    assert row["day"] == date(1970, 1, 1) and row["t"].timestamp() == 0


def test_ids_and_intervals(spark):
    df = spark.range(10).select(F.monotonically_increasing_id().alias("i"), F.expr("timestamp'2024-01-01 00:00:00' + INTERVAL 4 HOURS").alias("t"))
    assert df.select("i").distinct().count() == 10 and df.first()["t"].hour == 4
    assert df.union(df).count() == 20


def test_an_empty_repeat_replaces_a_run(spark, tmp_path):
    base = f"{tmp_path}/delta"
    one = spark.createDataFrame([(1, "a")], "id int, v string")
    sinks.write_delta(one, base, "2024-01-01", "10-00")
    sinks.write_delta(one, base, "2024-01-01", "11-00")
    sinks.write_delta(one.where("false"), base, "2024-01-01", "10-00")
    assert tables.read_delta(spark, base, "2024-01-01").count() == 1


def test_latest_snapshot_goes_by_folder_names(spark, tmp_path):
    base = f"{tmp_path}/snap"
    assert tables.latest_snapshot(spark, base, "2024-01-03") is None
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        spark.createDataFrame([(day,)], "v string").write.parquet(f"{base}/snapshot_date={day}")
    found = tables.latest_snapshot(spark, base, "2024-01-03")
    assert [r["v"] for r in found.collect()] == ["2024-01-02"]
    assert all("snapshot_date=2024-01-02" in f for f in found.inputFiles())
    assert tables.latest_snapshot(spark, base, "2024-01-01") is None


def test_days_of_clashing_types_are_read_together(spark, tmp_path):
    base = str(tmp_path / "t")
    for n, value in ((1, F.lit(1).cast("bigint")), (2, F.lit("high")), (3, F.lit(2).cast("bigint"))):
        spark.range(1).select(value.alias("Rank")).write.parquet(f"{base}/partdate=2024-01-0{n}")
    days = [date(2024, 1, n) for n in (1, 2, 3, 4)]
    found = tables.read_partitions(spark, base, "partdate", days)
    assert sorted(map(tuple, found.collect())) == [("1", days[0]), ("2", days[2]), ("high", days[1])]
    # one scan for each schema, not for each day
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_written_keys_take_half_their_digits(spark, tmp_path):
    rows = spark.range(20000).select(F.md5(F.col("id").cast("string")).alias("Id"), F.lit("2024-01-01").cast("date").alias("day"))
    size = lambda place: sum(f.stat().st_size for f in place.rglob("*.parquet"))
    sinks.write_delta(rows, str(tmp_path / "delta"), "2024-01-01", "01-00")
    sinks.replace_partitions(rows, str(tmp_path / "table"), ["day"])
    staged = sinks.stage(rows, str(tmp_path / "staged"))
    for place in ("delta", "table", "staged"):  # 32 hex digits hold 16 bytes
        assert size(tmp_path / place) < 24 * 20000
    assert staged.exceptAll(rows).isEmpty() and staged.count() == 20000
