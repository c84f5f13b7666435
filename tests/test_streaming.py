"""Drained streams: restart, new files, replays, de-duplication, clean-up of sources."""

from datetime import date, datetime

from pyspark.sql import functions as F

from feedfold.sources import kafka
from feedfold.streaming import feeds

SCHEMA = "id bigint, day date, ts timestamp, v string, n bigint"


def _write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _row(i, day, v, n):
    return (i, date(2024, 1, day), datetime(2024, 1, day, 5), v, n)


def test_drain_restarts_where_it_stopped(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    _write(spark, src, [_row(1, 1, "a", 1), _row(2, 1, "b", 1)])
    stream = lambda: kafka.file_feed(spark, src, SCHEMA, max_files=1)
    feeds.drain_to_files(stream(), out, ckpt)
    feeds.drain_to_files(stream(), out, ckpt)
    assert spark.read.parquet(out).count() == 2
    _write(spark, src, [_row(3, 2, "c", 1)])
    feeds.drain_to_files(stream(), out, ckpt)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_upserts_of_a_stream_equal_one_batch(spark, tmp_path):
    src, table, batch = (str(tmp_path / n) for n in ("src", "table", "batch"))
    first = [_row(1, 1, "a", 1), _row(2, 1, "b", 1), _row(1, 1, "a2", 2)]
    second = [_row(1, 1, None, 3), _row(3, 2, "c", 1)]
    for rows in (first, second):
        _write(spark, src, rows)
        handler = feeds.upsert_handler(table, "day", ["id"], ["n"])
        feeds.drain(kafka.file_feed(spark, src, SCHEMA), handler, str(tmp_path / "ckpt"))
    for rows in (first, second):
        feeds.upsert_partitions(spark.createDataFrame(rows, SCHEMA), batch, "day", ["id"], ["n"])
    cols = ["id", "day", "ts", "v", "n"]
    got = {tuple(r) for r in spark.read.parquet(table).select(cols).collect()}
    assert got == {tuple(r) for r in spark.read.parquet(batch).select(cols).collect()}
    assert {(r[0], r[3], r[4]) for r in got} == {(1, "a2", 3), (2, "b", 1), (3, "c", 1)}


def test_a_replayed_batch_changes_nothing_and_undated_rows_stay_out(spark, tmp_path):
    table = str(tmp_path / "table")
    handler = feeds.upsert_handler(table, "day", ["id"], ["n"])
    batch = spark.createDataFrame([_row(1, 1, "a", 1), (9, None, None, "x", 1)], SCHEMA)
    for _ in range(2):
        handler(batch, 0)
    handler(batch.limit(0), 1)
    assert [(r["id"], r["v"]) for r in spark.read.parquet(table).collect()] == [(1, "a")]


def test_dedupe_within_horizon(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    for rows in ([_row(1, 1, "a", 1), _row(1, 1, "again", 2)], [_row(1, 1, "replayed", 1), _row(2, 3, "b", 1)]):
        _write(spark, src, rows)
        unique = feeds.dedupe_stream(kafka.file_feed(spark, src, SCHEMA), ["id"], "ts")
        feeds.drain_to_files(unique, out, ckpt)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_lateness_bound(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    _write(spark, src, [_row(1, 1, "a", 1), _row(2, 9, "b", 1)])
    stream = feeds.within_horizon(kafka.file_feed(spark, src, SCHEMA), "ts", date(2024, 1, 5))
    feeds.drain_to_files(stream, out, str(tmp_path / "ckpt"))
    assert [r["id"] for r in spark.read.parquet(out).collect()] == [2]


def test_consumed_files_can_be_archived(spark, tmp_path):
    src, out, ckpt, old = (str(tmp_path / n) for n in ("src", "out", "ckpt", "old"))
    for i in range(3):
        _write(spark, src, [_row(i, 1, "a", 1)])
        feed = kafka.file_feed(spark, src, SCHEMA, clean_source="archive", archive_dir=old)
        feeds.drain_to_files(feed, out, ckpt)
    assert spark.read.parquet(out).select(F.countDistinct("id")).first()[0] == 3
    left = list((tmp_path / "src").glob("*.parquet"))
    assert len(left) < 3 and len(list((tmp_path / "old").rglob("*.parquet"))) == 3 - len(left)


def test_dedupe_without_salts_gives_the_same(spark, tmp_path):
    src = str(tmp_path / "src")
    _write(spark, src, [_row(i % 5, 1, "a", i) for i in range(50)])
    for salts in (1, 8):
        out = str(tmp_path / f"out{salts}")
        unique = feeds.dedupe_stream(kafka.file_feed(spark, src, SCHEMA), ["id"], "ts", salts=salts)
        feeds.drain_to_files(unique, out, str(tmp_path / f"ckpt{salts}"))
        assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]


def _drained(spark, src, out, ckpt, build, mode="append"):
    handler = lambda batch, n: batch.drop("_settles").write.mode("overwrite").parquet(f"{out}/batch={n}")
    return feeds.drain(build(kafka.file_feed(spark, src, SCHEMA)), handler, ckpt, mode)


def test_a_later_newer_copy_replaces_and_state_is_one_entry_per_key(spark, tmp_path):
    src, table, ckpt = (str(tmp_path / n) for n in ("src", "table", "ckpt"))
    runs = (
        [_row(1, 20, "old", 1), _row(2, 20, "b", 5)] + [_row(3, 20, f"c{n}", n) for n in range(50)],
        [_row(1, 20, "new", 9), _row(2, 20, "older", 4), _row(4, 21, None, 1)],
        [_row(5, 28, "e", 1)],
        [_row(1, 20, "too late", 10), _row(5, 28, "e2", 2)],
    )
    for rows in runs:
        _write(spark, src, rows)
        newest = feeds.newest_stream(kafka.file_feed(spark, src, SCHEMA), ["id"], ["n"], "day", "3 days")
        handler = feeds.upsert_handler(table, "day", ["id"], ["n"], transform=lambda b: b.drop("_settles"))
        progress = feeds.drain(newest, handler, ckpt, "update")
    got = {(r["id"], r["day"].day): (r["v"], r["n"]) for r in spark.read.parquet(table).collect()}
    assert got == {(1, 20): ("new", 9), (2, 20): ("b", 5), (3, 20): ("c49", 49), (4, 21): (None, 1), (5, 28): ("e2", 2)}
    # days 20 and 21 are settled and let go of; one entry for the key that is left
    assert progress["stateOperators"][0]["numRowsTotal"] == 1


def test_stream_join_equals_the_batch_join_of_settled_days(spark, tmp_path):
    import random

    rng = random.Random(5)
    rows = lambda side: [_row(rng.randrange(6), rng.randrange(1, 9), f"{side}{i}", i) for i in range(60)]
    posts, metrics = rows("p"), rows("m")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    got = []
    for part in (slice(0, 30), slice(30, 60)):  # in order of days, so that no row comes after its day is settled
        for side, all_rows in (("p", posts), ("m", metrics)):
            _write(spark, f"{tmp_path}/{side}", sorted(all_rows, key=lambda r: r[1])[part])
        sides = [kafka.file_feed(spark, f"{tmp_path}/{side}", SCHEMA) for side in "pm"]
        joined = feeds.join_streams(*sides, "id", ["n"], "day", "1 day")
        feeds.drain(joined, lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch={n}"), ckpt)
    got = spark.read.parquet(out)
    assert got.columns == ["id", "day", "ts", "v", "n", "tsMetrics", "vMetrics", "nMetrics", "batch"]
    newest = lambda side: {k: max(r[4] for r in side if (r[0], r[1]) == k) for k in {(r[0], r[1]) for r in side}}
    p, m = newest(posts), newest(metrics)
    want = {(k, p.get(k), m.get(k)) for k in set(p) | set(m)}
    made = [((r["id"], r["day"]), r["n"], r["nMetrics"]) for r in got.collect()]
    settled = max(d for (_, d), _, _ in made)
    assert len(made) == len(set(made)) and settled >= date(2024, 1, 5)
    assert set(made) == {w for w in want if w[0][1] <= settled}


def test_late_and_undated_rows_are_drained_apart(spark, tmp_path):
    src = str(tmp_path / "src")
    _write(spark, src, [_row(1, 1, "a", 1), _row(2, 9, "b", 1), (3, None, None, "c", 1)])
    for name, cut in (("in", feeds.within_horizon), ("out", feeds.beyond_horizon)):
        feeds.drain_to_files(cut(kafka.file_feed(spark, src, SCHEMA), "ts", date(2024, 1, 5)), f"{tmp_path}/{name}", f"{tmp_path}/ckpt-{name}")
    assert [r["id"] for r in spark.read.parquet(f"{tmp_path}/in").collect()] == [2]
    assert {(r["id"], r["_left_out"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {(1, "late"), (3, "undated")}


def test_undated_rows_of_a_batch_are_kept(spark, tmp_path):
    table = str(tmp_path / "table")
    handler = feeds.upsert_handler(table, "day", ["id"], ["n"])
    batch = spark.createDataFrame([_row(1, 1, "a", 1), (9, None, None, "x", 1)], SCHEMA)
    for _ in range(2):
        handler(batch, 0)
    handler(spark.createDataFrame([(8, None, None, "y", 1)], SCHEMA), 0)
    kept = spark.read.parquet(f"{table}/_left_out")
    assert sorted(r["id"] for r in kept.collect()) == [8, 9] and spark.read.parquet(table).count() == 1
