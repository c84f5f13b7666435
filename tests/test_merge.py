"""Snapshot, upsert, posts with metrics, child rows."""

from datetime import date, datetime

from pyspark.sql import functions as F

from feedfold.operators import merge as M


def d(n, month=1):
    return date(2024, month, n)


# --- window ----------------------------------------------------------------

def test_window_is_closed_and_outside_rows_are_counted(spark):
    a = spark.createDataFrame([(d(1),), (d(2),), (d(4),), (None,)], "PartDate date")
    b = spark.createDataFrame([(d(3),), (d(9),)], "PartDate date")
    days, outside = M.window_profile([a, b], "PartDate", "2024-01-02", "2024-01-04")
    assert days == [d(2), d(3), d(4)] and outside == 3


def test_window_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(d(1), 1)], "PartDate date, v int").write.parquet(path)
    df = spark.read.parquet(path).where(M.in_window("PartDate", "2024-01-01", "2024-01-05"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(PartDate" in plan and "LessThanOrEqual(PartDate" in plan


# --- snapshot --------------------------------------------------------------

HISTORY = [("a", 1, "old"), ("b", 1, "old"), ("c", 1, "old")]
DELTA = [("b", 5, "late", True), ("b", 7, "new", None), ("d", 2, "new", True)]


def _snapshot(spark, **kw):
    history = spark.createDataFrame(HISTORY, "k string, ts int, v string")
    delta = spark.createDataFrame(DELTA, "k string, ts bigint, v string, extra boolean")
    out = M.snapshot_merge(history, delta, ["k"], ["ts"], **kw)
    return {r["k"]: (r["ts"], r["v"], r["extra"]) for r in out.collect()}, out


def test_snapshot_replaces_whole_rows_and_keeps_the_rest(spark):
    want = {"a": (1, "old", None), "b": (7, "new", None), "c": (1, "old", None), "d": (2, "new", True)}
    got, _ = _snapshot(spark)
    assert got == want
    clustered, out = _snapshot(spark, clusters=5)
    assert clustered == want
    assert out.rdd.getNumPartitions() == 5


def test_clustered_snapshot_shuffles_history_once(spark):
    _, out = _snapshot(spark, clusters=5)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # one exchange for history, two for the delta: its keys, which say what goes, and its rows
    assert plan.count("Exchange hashpartitioning") == 3


def test_snapshot_of_repeated_history_keys_is_the_same_in_any_layout(spark):
    history = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("b", 2, "z"), (None, 1, "n")], "k string, ts int, v string")
    delta = spark.createDataFrame([("b", 5, "new"), (None, 4, "m"), (None, 3, "l")], "k string, ts int, v string")
    want = [("a", 1, "x"), ("a", 2, "y"), ("b", 5, "new"), (None, 1, "n"), (None, 4, "m")]
    for clusters in (None, 4):
        out = M.snapshot_merge(history, delta, ["k"], ["ts"], clusters=clusters)
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


# --- column-wise upsert -----------------------------------------------------

def test_delta_value_wins_unless_null(spark):
    history = spark.createDataFrame([(1, "h1", 10, (1, "x")), (2, "h2", 20, None)], "id int, a string, b int, s struct<x:int,y:string>")
    delta = spark.createDataFrame([(2, None, 21, (5,)), (3, "d3", None, None)], "id bigint, a string, b int, s struct<x:int>")
    rows = {r["id"]: r for r in M.coalesce_merge(history, delta, ["id"]).collect()}
    assert (rows[1]["a"], rows[1]["b"]) == ("h1", 10)
    assert (rows[2]["a"], rows[2]["b"], rows[2]["s"].asDict()) == ("h2", 21, {"x": 5, "y": None})
    assert (rows[3]["a"], rows[3]["b"]) == ("d3", None)


def test_upsert_is_repeatable(spark):
    history = spark.createDataFrame([(1, "h", 1), (2, "h", None)], "id int, a string, b int")
    delta = spark.createDataFrame([(2, None, 5), (3, "d", 6)], "id int, a string, b int")
    once = M.coalesce_merge(history, delta, ["id"])
    twice = M.coalesce_merge(once, delta, ["id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


# --- posts and metrics ------------------------------------------------------

POSTS = "Id string, PartDate date, Url string, CreateDate string, ParentUrl string, MetricsLikeCount bigint, MetricsCommentCount bigint, MetricsTimestamp string, CurrentTimestamp timestamp, ExecDate string, kafkaoffset bigint"
METRICS = "Id string, PartDate string, Likes bigint, Comments bigint, Reposts bigint, Views bigint, MetricsTimestamp string, CurrentTimestamp timestamp, BlogUrl string, CommentNegativeCount bigint, ExecDate string, KafkaOffset bigint"


def _ts(h):
    return datetime(2024, 1, 5, h)


def _join(spark, posts, metrics, lower="2024-01-01", upper="2024-01-05"):
    p = spark.createDataFrame(posts, POSTS)
    m = spark.createDataFrame(metrics, METRICS)
    return M.join_posts_metrics(p, m, lower, upper)


def test_stream_metrics_win_over_embedded_and_both_sides_survive(spark):
    posts = [
        ("p1", d(1), "https://t.me/1", "2024-01-01", None, 1, 2, "2024-01-01T05", _ts(1), "e", 1),
        ("p2", d(2), "https://vk.com/2", "2024-01-02", None, 3, None, None, _ts(1), "e", 2),
    ]
    metrics = [
        ("p1", "2024-01-01T23:10:00", 10, None, 4, 5, "2024-01-02T00", _ts(2), "b", 7, "e", 1),
        ("p3", "2024-01-03", 30, 31, None, None, "2024-01-03T00", _ts(2), "b", None, "e", 2),
    ]
    rows = {r["PostId"]: r for r in _join(spark, posts, metrics).collect()}
    assert set(rows) == {"p1", "p2", "p3"}
    assert (rows["p1"]["LikesCount"], rows["p1"]["CommentsCount"], rows["p1"]["RepostsCount"]) == (10, 2, 4)
    assert rows["p1"]["MetricsTimestamp"] == "2024-01-02T00"
    assert rows["p2"]["LikesCount"] == 3 and rows["p2"]["MetricsTimestamp"] is None
    assert rows["p3"]["PartdatePmd"] == d(3) and rows["p3"]["Url"] is None
    assert rows["p1"]["CurrentTimestampMetrics"] == _ts(2)


def test_newest_of_embedded_and_stream_time_counts(spark):
    posts = [("p", d(1), "u", "c", None, 1, 1, "2024-01-09T00", _ts(1), "e", 1)]
    metrics = [("p", "2024-01-01", 5, None, None, None, "2024-01-02T00", _ts(1), "b", None, "e", 1)]
    assert _join(spark, posts, metrics).first()["MetricsTimestamp"] == "2024-01-09T00"


def test_newest_message_of_each_side_is_joined_not_every_pair(spark):
    posts = [("p", d(1), f"u{i}", "c", None, i, 0, None, _ts(i % 20), "e", i) for i in range(300)]
    metrics = [("p", "2024-01-01", i, None, None, None, f"2024-01-02T{i:04d}", _ts(1), "b", None, "e", i) for i in range(300)]
    out = _join(spark, posts, metrics)
    row = out.first()
    assert out.count() == 1 and row["LikesCount"] == 299 and row["Url"] == "u299"


def test_window_drops_late_and_future_days_and_order_has_nulls_last(spark):
    posts = [("late", d(1), "u", "c", None, 1, 1, None, _ts(1), "e", 1), ("in", d(4), "u", "c", None, 1, 1, None, _ts(1), "e", 2)]
    metrics = [
        ("in", "2024-01-04", 1, None, None, None, None, _ts(1), "b", None, "e", 9),
        ("in", "2024-01-04", 2, None, None, None, "2024-01-04", _ts(1), "b", None, "e", 1),
        ("future", "2024-02-01", 1, None, None, None, "x", _ts(1), "b", None, "e", 1),
    ]
    rows = _join(spark, posts, metrics, lower="2024-01-03").collect()
    assert [(r["PostId"], r["LikesCount"]) for r in rows] == [("in", 2)]


def test_a_post_survives_metrics_of_another_day(spark):
    posts = [
        ("p", d(1), "old", "c", None, 1, 1, None, _ts(1), "e", 1),
        ("p", d(2), "new", "c", None, 2, 1, None, _ts(2), "e", 2),
    ]
    metrics = [("p", f"2024-01-0{n}", n, None, None, None, f"2024-01-0{n}", _ts(3), "b", None, "e", n) for n in (1, 2, 4)]
    rows = sorted((r["PartdatePmd"], r["Url"], r["LikesCount"]) for r in _join(spark, posts, metrics).collect() if r["Url"])
    assert rows == [(d(2), "new", 2)]
    rest = {r["PartdatePmd"]: r["LikesCount"] for r in _join(spark, posts, metrics).collect() if not r["Url"]}
    assert rest == {d(1): 1, d(4): 4}


def test_posts_without_any_embedded_columns(spark):
    p = spark.createDataFrame([("p", d(1), "u")], "Id string, PartDate date, Url string")
    m = spark.createDataFrame([("p", "2024-01-01", 5, None, None, None, "t", _ts(1), "b", None, "e", 1)], METRICS)
    row = M.join_posts_metrics(p, m, "2024-01-01", "2024-01-02").first()
    assert row["LikesCount"] == 5 and row["ViewsCount"] is None


def test_frames_with_keys_alone(spark):
    p = spark.createDataFrame([("p", d(1), "u")], "Id string, PartDate date, Url string")
    m = spark.createDataFrame([("q", d(2))], "Id string, PartDate date")
    delta = M.join_posts_metrics(p, m, "2024-01-01", "2024-01-05")
    merged = M.upsert_posts(None, delta)
    assert merged.count() == 2 and dict(merged.dtypes)["CommentsCount"] == "bigint"


def test_first_and_later_runs_have_one_schema_and_values_carry_over(spark):
    posts = [("p", d(1), "https://t.me/1", "c", "https://t.me/0", 1, 2, None, _ts(1), "e1", 1)]
    metrics = [("p", "2024-01-01", 10, None, None, None, "t1", _ts(1), "b", 3, "e1", 1)]
    first = M.upsert_posts(None, _join(spark, posts, metrics))
    assert first.columns == [*M.MERGED_COLUMNS, "SocialnetworkType"]
    row = first.first()
    assert (row["MetricsLikesCount"], row["MetricsCommentsCount"], row["SocialnetworkType"]) == (10, 2, 17)
    # metrics alone on a later day: everything else comes from history
    later = _join(spark, [], [("p", "2024-01-01", 20, None, None, None, "t2", _ts(2), None, None, "e2", 5)])
    second = M.upsert_posts(first, later)
    assert second.columns == first.columns and second.schema == first.schema
    new = second.first()
    assert (new["MetricsLikesCount"], new["Url"], new["CommentNegativeCount"]) == (20, "https://t.me/1", 3)
    assert new["ParentUrlHash"] == row["ParentUrlHash"] is not None
    assert new["SocialnetworkType"] == 17 and new["MetricsTimestamp"] == "t2"


def test_null_parent_gives_null_hash_and_key_function_is_replaceable(spark):
    posts = [("p", d(1), "u", "c", None, 1, 2, None, _ts(1), "e1", 1), ("q", d(1), "u", "c", "par", 1, 2, None, _ts(1), "e1", 1)]
    rows = {r["PostId"]: r["ParentUrlHash"] for r in M.upsert_posts(None, _join(spark, posts, []), key_fn=F.upper).collect()}
    assert rows == {"p": None, "q": "PAR"}


def test_duplicate_history_is_cut_to_the_newest_row(spark):
    history = spark.createDataFrame(
        [("p", d(1), "old", "t1", 1), ("p", d(1), "newer", "t2", 2), ("h", d(1), "kept", None, 3)],
        "PostId string, Partdate date, Url string, MetricsTimestamp string, Legacy int",
    )
    posts = [("p", d(1), None, "c", None, 1, 2, None, _ts(1), "e1", 1)]
    rows = {r["PostId"]: r for r in M.upsert_posts(history, _join(spark, posts, [])).collect()}
    assert rows["p"]["Url"] == "newer" and rows["p"]["Legacy"] == 2 and rows["h"]["Url"] == "kept"


def test_nested_history_and_delta_are_brought_together(spark):
    posts = spark.createDataFrame([("p", d(1), "u", [(1, "k")])], "Id string, PartDate date, Url string, Topics array<struct<Id:bigint,key:string>>")
    delta = M.join_posts_metrics(posts, spark.createDataFrame([], METRICS), "2024-01-01", "2024-01-02")
    first = M.upsert_posts(None, delta)
    assert first.first()["Topics"][0]["key"] == "k"
    metrics_only = spark.createDataFrame([], "Id string, PartDate date, Url string")
    m = spark.createDataFrame([("p", "2024-01-01", 5, None, None, None, "t", _ts(1), "b", None, "e", 1)], METRICS)
    second = M.upsert_posts(first, M.join_posts_metrics(metrics_only, m, "2024-01-01", "2024-01-02"))
    assert second.first()["Topics"][0]["key"] == "k"


# --- children ---------------------------------------------------------------

CHILD = "Id string, PartDate date, PostCreateDate string, v int"


def _children(spark, history, ties="all"):
    delta = spark.createDataFrame(
        [("p", d(1), "t1", 1), ("p", d(1), "t2", 2), ("p", d(1), "t2", 3), ("q", d(1), "t1", 4), ("orphan", d(1), "t1", 5), ("late", d(1, 2), "t1", 6)], CHILD
    )
    posts = spark.createDataFrame([("p", d(1)), ("q", d(1)), ("r", d(1)), ("late", d(1, 2))], "PostId string, Partdate date")
    out = M.merge_children(history, delta, posts, "2024-01-01", "2024-01-31", ties=ties)
    return sorted((r["PostId"], r["v"]) for r in out.collect())


def test_children_keep_all_rows_of_the_newest_version(spark):
    assert _children(spark, None) == [("p", 2), ("p", 3), ("q", 4)]
    assert _children(spark, None, ties="one") == [("p", 3), ("q", 4)]


def test_children_are_replaced_per_post(spark):
    history = spark.createDataFrame(
        [("p", d(1), "t0", 90), ("r", d(1), "t0", 91), ("r", d(1), "t0", 92)], "PostId string, Partdate date, PostCreateDate string, v int"
    )
    assert _children(spark, history) == [("p", 2), ("p", 3), ("q", 4), ("r", 91), ("r", 92)]


def test_children_of_the_newest_message_only(spark):
    delta = spark.createDataFrame(
        [("p", d(1), "t1", 7, 1), ("p", d(1), "t1", 8, 1), ("p", d(1), "t1", 8, 2)], "Id string, PartDate date, PostCreateDate string, kafkaoffset bigint, v int"
    )
    posts = spark.createDataFrame([("p", d(1))], "PostId string, Partdate date")
    out = M.merge_children(None, delta, posts, "2024-01-01", "2024-01-31")
    assert sorted(r["v"] for r in out.collect()) == [1, 2]


def test_upsert_with_null_keys_can_be_repeated(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b")], "id int, v string")
    new = spark.createDataFrame([(None, "c"), (2, "d")], "id int, v string")
    once = M.coalesce_merge(old, new, ["id"])
    twice = M.coalesce_merge(once, new, ["id"])
    want = [(None, "c"), (1, "b"), (2, "d")]
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr) == sorted(want, key=repr)
