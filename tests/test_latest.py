"""Newest rows, ties, and plans under skew."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from feedfold.operators.latest import latest_per_key
from feedfold.operators.matching import match_rows, row_salt


def test_nulls_last_and_total_order(spark):
    rows = [("a", None, 9, "x"), ("a", 2, 1, "p"), ("a", 2, 3, "q"), ("b", None, 1, "r"), (None, 1, 1, "n"), (None, 2, 1, "m")]
    df = spark.createDataFrame(rows, "k string, ts int, tie int, v string")
    got = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], ["ts"]).collect()}
    assert got == {"a": "q", "b": "r", None: "m"}


def test_all_ties_keep_every_row_of_the_newest_version(spark):
    rows = [("a", 1, None, 1), ("a", 2, 5, 2), ("a", 2, 5, 3), ("a", 2, 5, 3), ("a", 2, None, 4), ("b", None, None, 5), ("b", None, None, 6), (None, 3, 1, 7)]
    df = spark.createDataFrame(rows, "k string, d int, o int, v int")
    got = sorted(r["v"] for r in latest_per_key(df, ["k"], ["d", "o"], ties="all").collect())
    assert got == [2, 3, 3, 5, 6, 7]
    one = sorted(r["v"] for r in latest_per_key(df, ["k"], ["d"], ties="all").collect())
    assert one == [2, 3, 3, 4, 5, 6, 7]
    with pytest.raises(ValueError):
        latest_per_key(df, ["k"], ["d"], ties="some")


def test_maps_do_not_break_the_default_tiebreak(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 2, {"x": 2})], "k string, ts int, m map<string,int>")
    assert latest_per_key(df, ["k"], ["ts"]).first()["m"] == {"x": 2}


def test_match_rows_treats_nulls_as_equal(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    keys = spark.createDataFrame([(1,), (None,)], "k int")
    assert {r["v"] for r in match_rows(rows, keys, ["k"], "left_semi").collect()} == {"a", "b"}
    assert {r["v"] for r in match_rows(rows, keys, ["k"], "left_anti").collect()} == {"c"}
    with pytest.raises(ValueError):
        match_rows(rows, keys, ["k"], "inner")


def test_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_a_key_with_most_rows_is_spread(spark, tmp_path):
    """One key holds over a third of the rows, half of them copies of one row."""
    hot = spark.range(0, 60_000, 1, 16).select(F.lit("hot").alias("k"), F.lit(date(2024, 1, 2)).alias("d"), F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(0).alias("v"))
    rest = spark.range(0, 60_000, 1, 16).select(F.concat(F.lit("k"), F.col("id") % 5_000).alias("k"), F.lit(date(2024, 1, 1)).alias("d"), F.col("id").alias("v"))
    path = str(tmp_path / "rows")
    hot.unionByName(rest).write.parquet(path)
    # small files stay apart, as the splits of a large table would
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        df = spark.read.parquet(path)
        newest = latest_per_key(df, ["k"], ["d"], ties="all", salts=8)
        assert newest.count() == 120_000
        per_salt = df.where("k = 'hot'").groupBy(row_salt(df, 8)).count().collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(per_salt) == 8 and max(r["count"] for r in per_salt) < 60_000 / 4


def test_salts_read_no_wide_columns(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([("k", 1, "long text", 5)], "k string, d int, body string, n bigint").write.parquet(path)
    newest = latest_per_key(spark.read.parquet(path), ["k"], ["d"], ties="all").select("k", "n")
    assert "body" not in newest._jdf.queryExecution().executedPlan().toString()


def test_without_salts_a_key_list_is_not_repeated(spark):
    rows = spark.range(100).withColumn("k", F.col("id") % 7)
    keys = spark.range(5).withColumnRenamed("id", "k")
    kept = match_rows(rows, keys, ["k"], "left_semi")
    assert "Generate" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, match_rows(rows, keys, ["k"], "left_semi", 8).collect()))


@pytest.mark.parametrize("salts", [1, 4])
def test_aqe_splits_a_hot_key(spark, tmp_path, salts):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        path = str(tmp_path / "rows")
        ids = spark.range(0, 100_000, 1, 8)
        ids.select(
            F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
            F.lit(1).alias("d"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
        ).write.parquet(path)
        newest = latest_per_key(spark.read.parquet(path), ["k"], ["d"], ties="all", salts=salts)
        rows = newest.select("k", "v")
        assert len(rows.collect()) == 100_000
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
