"""The jobs end to end on synthetic feeds."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.functions import url_key
from feedfold.operators import split as P
from feedfold.plans import jobs
from feedfold.sources import kafka, sinks, tables
from feedfold.sources.leftout import Held
from feedfold.sources.retention import remove_consumed
from feedfold.streaming import feeds
from messages import BLOG, METRICS, POST, POST_EXCLUDES, POST_PRIMARY, envelope, messages

URL = "https://t.me/channel/1"
BLOG_POLICY = P.FieldPolicy.parse('{"Trace": [], "Nowhere": []}', "Url,UrlHash,Metrics.LikeCount")
POST_POLICY = P.FieldPolicy.parse(POST_EXCLUDES, POST_PRIMARY)


def _run(day, time="10-00", topic="t"):
    return jobs.Run(day, time, topic, "g")


def test_blogs_end_to_end(spark, tmp_path):
    delta, snap, ledger = (str(tmp_path / n) for n in ("delta", "snap", "ledger"))
    blogs = messages(spark, BLOG, 100, Url=URL, UrlHash=url_key(F.lit(URL)))
    jobs.ingest_blogs(blogs, _run("2024-01-01"), BLOG_POLICY, delta, ledger)
    day = tables.read_delta(spark, delta, "2024-01-01")
    assert day.count() == 100 and "Trace" not in day.columns and "Metrics" in day.columns
    jobs.merge_blogs(spark, "2024-01-01", delta, snap, clusters=4)
    merged = tables.latest_snapshot(spark, snap, "2024-01-02")
    assert merged.where(F.col("AccountId") == url_key(F.lit(URL))).count() == 1 and merged.count() == 1
    # next day: another account with a new field and a clashing type; the first one stays
    other = messages(spark, BLOG, 3, Url="u2", UrlHash="h2", Nick=7, Fresh="x")
    jobs.ingest_blogs(other, _run("2024-01-02"), BLOG_POLICY, delta, ledger)
    for _ in range(2):
        jobs.merge_blogs(spark, "2024-01-02", delta, snap, clusters=4)
    merged = {r["AccountId"]: r for r in tables.latest_snapshot(spark, snap, "2024-01-03").collect()}
    assert len(merged) == 2 and merged["h2"]["Nick"] == "7" and merged["h2"]["Fresh"] == "x"
    assert merged[url_key_of(URL)]["Fresh"] is None and merged["h2"]["MergeDate"] == "20240102"
    # a day without a delta carries the snapshot on, also over a gap
    jobs.merge_blogs(spark, "2024-01-05", delta, snap, clusters=4)
    assert tables.latest_snapshot(spark, snap, "2024-01-06").count() == 2
    starting, first = kafka.feed_start(sinks.read_ledger(spark, ledger), kafka.Feed("b", "t", "g"))
    assert not first and set(json.loads(starting)["t"]) == {"0", "1"}


def url_key_of(text):
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()


def test_unreadable_history_fails_instead_of_starting_over(spark, tmp_path):
    delta, snap = str(tmp_path / "delta"), tmp_path / "snap"
    jobs.ingest_blogs(messages(spark, BLOG, 2, Url=URL, UrlHash="h"), _run("2024-01-02"), BLOG_POLICY, delta)
    broken = snap / "snapshot_date=2024-01-01"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        jobs.merge_blogs(spark, "2024-01-02", delta, str(snap), clusters=2)


def test_unreadable_and_unkeyed_messages_go_to_dead_letters_and_count_in_the_ledger(spark, tmp_path):
    delta, dead, ledger = (str(tmp_path / n) for n in ("delta", "dead", "ledger"))
    texts = ['{"Url":"u","Metrics":{"LikeCount":1}}', "broken{", None, '{"Metrics":{"LikeCount":2}}', '{"Url":"v","Blog":{"Type":3}}']
    feed = envelope(spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1))
    for _ in range(2):
        jobs.ingest_metrics(feed, _run("2024-01-01"), delta, ledger, dead)
    rows = {r["metricsurl"]: r for r in tables.read_delta(spark, delta, "2024-01-01").collect()}
    assert set(rows) == {"u", "v"} and rows["u"]["likes"] == 1 and rows["v"]["blogtype"] == 3
    assert rows["u"]["id"] == url_key_of("u")
    assert tables.read_delta(spark, dead, "2024-01-01").count() == 3
    assert max(r["latestoffset"] for r in sinks.read_ledger(spark, ledger).collect()) == 4
    jobs.ingest_metrics(envelope(spark.createDataFrame([("nope",)], "value string")), _run("2024-01-02"), delta, ledger, dead)
    empty = tables.read_delta(spark, delta, "2024-01-02")
    assert empty is None or empty.count() == 0


def test_messages_that_do_not_fit_a_given_schema_are_unreadable(spark, tmp_path):
    delta, dead = str(tmp_path / "delta"), str(tmp_path / "dead")
    schema = T.StructType.fromDDL("Url string, Metrics struct<LikeCount:bigint>")
    texts = ['{"Url":"u","Metrics":{"LikeCount":1},"More":2}', '{"Url":"v","Metrics":{"LikeCount":"many"}}']
    feed = envelope(spark.createDataFrame([(t,) for t in texts], "value string"))
    jobs.ingest_metrics(feed, _run("2024-01-01"), delta, dead_letters=dead, schema=schema)
    assert [r["metricsurl"] for r in tables.read_delta(spark, delta, "2024-01-01").collect()] == ["u"]
    assert [r["value"] for r in tables.read_delta(spark, dead, "2024-01-01").collect()] == [texts[1]]


def test_metrics_in_two_halves(spark, tmp_path):
    delta = str(tmp_path / "delta")
    for time, likes in (("10-00", 10), ("12-00", 50)):
        metrics = F.struct(F.lit(likes).alias("LikeCount"), F.lit(30).alias("RepostCount"), F.lit(120).alias("ViewCount"))
        jobs.ingest_metrics(messages(spark, METRICS, 5, Url=URL, Metrics=metrics), _run("2024-01-01", time), delta)
    got = tables.read_delta(spark, delta, "2024-01-01").groupBy("exec_time", "likes").count().collect()
    assert sorted(tuple(r) for r in got) == [("10-00", 10, 5), ("12-00", 50, 5)]


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    """Posts and metrics of two days, each merge run twice."""
    root = tmp_path_factory.mktemp("posts")
    place = lambda name: str(root / name)
    delta = lambda part: place(f"delta/{part}")
    attachments = lambda n: F.expr(
        f"transform(sequence(1, {n}), x -> struct(x AS Type, concat('b', x) AS Body, struct(x AS SymbolCount) AS BodyStats, "
        "struct('o' AS Body, 'ru' AS Lang) AS Ocr))"
    )
    days = {
        "2024-01-02": [dict(Url=URL, CreateDate="2024-01-01T10:00:00", Attachments=attachments(3), ParentUrl="https://t.me/p"),
                       dict(Url="https://vk.com/2", CreateDate="2024-01-01 11:00:00", Attachments=attachments(1)),
                       dict(Url="https://vk.com/late", CreateDate="2023-01-01")],
        "2024-01-03": [dict(Url=URL, CreateDate="2024-01-01T10:00:00", Attachments=attachments(2)),
                       dict(Url="https://x.com/3", CreateDate="2024-01-03", Attachments=F.lit(None).cast("array<int>"))],
    }
    metrics = {
        "2024-01-02": [(URL, "2024-01-01T22:00:00", 10, "2024-01-02T00:00:00"), (URL, "2024-01-01", 9, "2024-01-01T00:00:00")],
        "2024-01-03": [("https://vk.com/2", "2024-01-01", 77, "2024-01-03T00:00:00"), ("https://ok.example/4", "2024-01-02", 5, "2024-01-03")],
    }
    reports = {}
    for day, posts in days.items():
        feed = messages(spark, POST, 2, **posts[0])
        for post in posts[1:]:
            feed = feed.unionByName(messages(spark, POST, 2, **post))
        feed = envelope(feed.select("value").coalesce(1))
        jobs.ingest_posts(feed, _run(day, topic="p"), POST_POLICY, delta, place("ledger"))
        texts = [json.dumps({"Url": u, "CreateDate": c, "Metrics": {"LikeCount": n, "Timestamp": t}}) for u, c, n, t in metrics[day]]
        jobs.ingest_metrics(envelope(spark.createDataFrame([(t,) for t in texts], "value string")), _run(day, topic="m"), delta("Metrics"))
        for _ in range(2):
            reports[day] = jobs.merge_posts(spark, day, "2023-12-15", delta("Posts"), delta("Metrics"), place("Posts"), max_days=1)
            jobs.merge_all_children(spark, day, "2023-12-15", delta, place)
    return place, delta, reports


def test_parts_join_on_id(spark, two_days):
    _, delta, _ = two_days
    parts = {p: tables.read_delta(spark, delta(p), "2024-01-02") for p in (P.PRIMARY, *P.CHILD_PARTS)}
    primary = parts[P.PRIMARY]
    assert primary.count() == 6 and {"AuthorUrl", "BlogMetricsFollowerCount", "MetricsTimestamp", "Toxicity", "Topics"} <= set(primary.columns)
    for name in P.CHILD_PARTS:
        assert primary.select("Id").distinct().join(parts[name], "Id").count() == parts[name].count() > 0
    assert "AuthorName" in parts[P.OTHER].columns and "AuthorUrl" not in parts[P.OTHER].columns
    # 2 messages each of 3, 1 and 1 (default) attachments
    assert parts[P.ATTACHMENTS].count() == 10
    assert "Body" not in parts[P.ATTACHMENTS].columns


def test_merged_posts(spark, two_days):
    place, _, reports = two_days
    assert reports["2024-01-02"].days == [date(2024, 1, 1)] and reports["2024-01-02"].outside == 2
    assert reports["2024-01-03"].days == [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)]
    rows = {r["PostId"]: r for r in spark.read.parquet(place("Posts")).collect()}
    assert set(rows) == {url_key_of(u) for u in (URL, "https://vk.com/2", "https://x.com/3", "https://ok.example/4")}
    first = rows[url_key_of(URL)]
    # day two brought the post without stream metrics: its embedded count is the newer value
    assert first["partdate"] == date(2024, 1, 1) and first["SocialnetworkType"] == 17
    assert (first["MetricsTimestamp"], first["MetricsLikesCount"], first["ExecDate"]) == ("", 0, "2024-01-03")
    assert first["ParentUrlHash"] is not None
    second = rows[url_key_of("https://vk.com/2")]
    assert second["MetricsLikesCount"] == 77 and second["Url"] == "https://vk.com/2" and second["SocialnetworkType"] == 7
    alone = rows[url_key_of("https://ok.example/4")]
    assert alone["Url"] is None and alone["MetricsLikesCount"] == 5 and alone["partdate"] == date(2024, 1, 2)


def test_merged_children(spark, two_days):
    place, _, _ = two_days
    rows = spark.read.parquet(place(P.ATTACHMENTS)).groupBy("PostId").agg(F.count("*").alias("n"), F.count("Type").alias("typed")).collect()
    got = {r["PostId"]: (r["n"], r["typed"]) for r in rows}
    # the newest message's attachments only; kept for the post of day one; none for the bare post
    assert got == {url_key_of(URL): (2, 2), url_key_of("https://vk.com/2"): (1, 1), url_key_of("https://x.com/3"): (1, 0)}
    for part in P.CHILD_PARTS:
        merged = spark.read.parquet(place(part))
        assert merged.select("PostId").distinct().count() == 3


def test_merges_without_input_do_nothing(spark, tmp_path):
    nothing = str(tmp_path / "none")
    assert jobs.merge_posts(spark, "2024-01-01", "2023-12-01", nothing, nothing, str(tmp_path / "m")).days == []
    assert jobs.merge_child_table(spark, "2024-01-01", "2023-12-01", nothing, nothing, str(tmp_path / "c")).days == []
    jobs.merge_blogs(spark, "2024-01-01", nothing, str(tmp_path / "s"))
    assert not (tmp_path / "m").exists() and not (tmp_path / "s").exists()


def test_metrics_alone_make_a_first_run(spark, tmp_path):
    delta, merged = str(tmp_path / "delta"), str(tmp_path / "merged")
    text = json.dumps({"Url": URL, "CreateDate": "2024-01-01", "Metrics": {"LikeCount": 4}})
    jobs.ingest_metrics(envelope(spark.createDataFrame([(text,)], "value string")), _run("2024-01-01"), delta)
    report = jobs.merge_posts(spark, "2024-01-01", "2023-12-01", str(tmp_path / "none"), delta, merged, rebalance=False)
    assert report.days == [date(2024, 1, 1)]
    assert spark.read.parquet(merged).first()["MetricsLikesCount"] == 4


def test_drained_ingest_equals_batch_ingest(spark, tmp_path):
    src, streamed, batch = (str(tmp_path / n) for n in ("src", "streamed", "batch"))
    for likes in (1, 2):
        metrics = F.struct(F.lit(likes).alias("LikeCount"))
        messages(spark, METRICS, 4, Url=URL, Metrics=metrics).coalesce(1).write.mode("append").parquet(src)
    schema = "value binary, partition int, offset bigint"
    ingest = lambda frame, run: jobs.ingest_metrics(frame, run, streamed, str(tmp_path / "ledger"))
    handler = jobs.ingest_handler(ingest, "2024-01-01", "m", "g", str(tmp_path / "ckpt"))
    feeds.drain(kafka.file_feed(spark, src, schema, max_files=1), handler, str(tmp_path / "ckpt"))
    handler(spark.read.schema(schema).parquet(src).limit(0), 7)
    jobs.ingest_metrics(spark.read.parquet(src), _run("2024-01-01"), batch)
    key = ["metricsurl", "likes", "partdate", "id", "kafkaoffset"]
    rows = lambda path: sorted(tuple(r) for r in tables.read_delta(spark, path, "2024-01-01").select(key).collect())
    assert rows(streamed) == rows(batch) and len(rows(batch)) == 8


# --- upkeep -----------------------------------------------------------------

def _post(url, day, likes=1, **more):
    return {"Url": url, "CreateDate": day, "Metrics": {"LikeCount": likes, "Timestamp": day}, "Attachments": [{"Type": likes}], **more}


def _feed(spark, records):
    return envelope(spark.createDataFrame([(json.dumps(r),) for r in records], "value string").coalesce(1))


def _metric(url, day, likes):
    return {"Url": url, "CreateDate": day, "Metrics": {"LikeCount": likes, "Timestamp": f"{day}T{likes:02d}"}}


@pytest.fixture
def feeds_of(spark, tmp_path):
    place = lambda name: str(tmp_path / name)

    def ingest(day, posts=(), metrics=(), time="10-00"):
        if posts:
            jobs.ingest_posts(_feed(spark, posts), _run(day, time), POST_POLICY, lambda p: place(f"delta/{p}"))
        if metrics:
            jobs.ingest_metrics(_feed(spark, metrics), _run(day, time), place("delta/Metrics"))

    def merge(day, lower="2024-01-01", **more):
        return jobs.merge_posts(spark, day, lower, place("delta/Posts"), place("delta/Metrics"), place("Posts"), **more)

    return place, ingest, merge


def _merged(spark, place):
    return {(r["Url"], str(r["partdate"])): r["CommentsCount"] for r in spark.read.parquet(place("Posts")).collect()}


def test_a_batch_reads_its_own_days(spark, feeds_of):
    place, ingest, merge = feeds_of
    for day in ("2024-01-03", "2024-01-04"):
        ingest(day, [_post(f"u{d}", f"2024-01-0{d}", d) for d in (1, 2, 3)], [_metric("u2", "2024-01-02", 5)])
        merge(day, max_days=1)
    joined = jobs.staging_path(spark, "joined", place("Posts"))
    assert tables._folders(spark, joined, "PartdatePmd") == [f"PartdatePmd=2024-01-0{d}" for d in (1, 2, 3)]
    assert len(_merged(spark, place)) == 3


def test_a_post_moves_with_its_day(spark, feeds_of):
    place, ingest, merge = feeds_of
    children = lambda day: jobs.merge_child_table(spark, day, "2024-01-01", place(f"delta/{P.ATTACHMENTS}"), place("Posts"), place("Attachments"))
    ingest("2024-01-03", [_post("u1", "2024-01-01", 1), _post("u2", "2024-01-01", 2), _post("u3", "2024-01-02", 3)], [{**_metric("u1", "2024-01-01", 5), "Blog": {"Url": "b"}}, _metric("u9", "2024-01-03", 5)])
    merge("2024-01-03"), children("2024-01-03")
    ingest("2024-01-04", [_post("u1", "2024-01-03", 7), _post("u3", "2024-01-01", 8)], [_metric("u3", "2024-01-04", 9)])
    for _ in range(2):
        report = merge("2024-01-04", max_days=2)
        children("2024-01-04")
        rows = {(r["PostId"], r["partdate"].day): r for r in spark.read.parquet(place("Posts")).collect()}
        key = url_key_of
        assert {k for k, r in rows.items() if r["Url"]} == {(key("u1"), 3), (key("u2"), 1), (key("u3"), 1)}
        # metrics of another day stay a row of that day, and the moved row keeps what the new message lacks
        assert (key("u3"), 4) in rows and (key("u9"), 3) in rows and len(rows) == 5
        assert rows[key("u1"), 3]["BlogUrl"] == "b"
        kept = {(r["PostId"], r["partdate"].day) for r in spark.read.parquet(place("Attachments")).collect()}
        assert kept == {(key("u1"), 3), (key("u2"), 1), (key("u3"), 1)}
    assert report.days[0] == date(2024, 1, 1)


def test_rows_left_out_come_back_when_a_window_admits_them(spark, feeds_of):
    place, ingest, merge = feeds_of
    upkeep = jobs.Upkeep(left_out=place("left"))
    posts = [_post("in", "2024-01-02"), _post("late", "2023-12-20"), _post("early", "2024-01-05"), _post("bare", "soon")]
    ingest("2024-01-03", posts, [_metric("late", "2023-12-20", 3), _metric("m", "2024-01-04", 4)])

    def left(kind):
        held = Held(spark, place(f"left/{kind}"), "2024-01-01", "2024-01-03")._rows
        return sorted((r["Url"] if kind == "posts" else r["metricsurl"], r["_left_out"]) for r in held.collect()) if held is not None else []

    for _ in range(2):
        report = merge("2024-01-03", upkeep=upkeep)
        assert report.outside == 5 and set(_merged(spark, place)) == {("in", "2024-01-02")}
        assert left("posts") == [("bare", "undated"), ("early", "early"), ("late", "late")]
        assert left("metrics") == [("late", "late"), ("m", "early")]
    # a later day admits what was early, without a delta of its own
    merge("2024-01-05", upkeep=upkeep)
    assert {u for u, _ in _merged(spark, place)} == {"in", "early", None} and left("posts") == [("bare", "undated"), ("late", "late")]
    # an older bound admits what was late, a given day what was undated
    days = spark.createDataFrame([(url_key_of("bare"), date(2024, 1, 1))], "Id string, PartDate date")
    merge("2024-01-05", "2023-12-01", upkeep=jobs.Upkeep(left_out=place("left"), days=days))
    assert {u for u, _ in _merged(spark, place)} == {"in", "early", "late", "bare", None}
    assert left("posts") == [] and left("metrics") == []
    assert _merged(spark, place)[("bare", "2024-01-01")] is not None or ("bare", "2024-01-01") in _merged(spark, place)


def test_folded_runs_go_once_all_readers_have_them(spark, feeds_of):
    place, ingest, merge = feeds_of
    ledger, base = place("consumed"), place("delta/Metrics")
    upkeep = jobs.Upkeep(consumed=ledger, consumer="posts")
    ingest("2024-01-03", [_post("a", "2024-01-02")], [_metric("a", "2024-01-02", 3)])
    ingest("2024-01-03", metrics=[_metric("a", "2024-01-02", 4)], time="11-00")
    remove = lambda readers: [r.rpartition("=")[2] for r in remove_consumed(spark, ledger, base, readers, place("archive"))]
    assert remove(["posts"]) == []
    merge("2024-01-03", upkeep=upkeep)
    before = sorted(map(tuple, spark.read.parquet(place("Posts")).select("PostId", "MetricsLikesCount").collect()))
    assert before[0][1] == 4
    assert remove(["posts", "audit"]) == []
    # written again after it was folded, and one that came since: both stay
    ingest("2024-01-03", metrics=[_metric("a", "2024-01-02", 5)], time="10-00")
    ingest("2024-01-03", metrics=[_metric("a", "2024-01-02", 6)], time="12-00")
    assert remove(["posts"]) == ["11-00"]
    assert [r.rpartition("=")[2] for r in tables.delta_runs(spark, base, "2024-01-03")] == ["10-00", "12-00"]
    merge("2024-01-03", upkeep=upkeep)
    after = sorted(map(tuple, spark.read.parquet(place("Posts")).select("PostId", "MetricsLikesCount").collect()))
    assert after[0][1] == 6 and remove(["posts"]) == ["10-00", "12-00"]
    # a replay finds no metrics and changes nothing
    merge("2024-01-03", upkeep=upkeep)
    replayed = sorted(map(tuple, spark.read.parquet(place("Posts")).select("PostId", "MetricsLikesCount").collect()))
    assert [r[0] for r in replayed] == [r[0] for r in after] and tables.read_delta(spark, base, "2024-01-03") is None


def test_day_batches_are_even_and_bounded():
    days = [date(2024, 1, n) for n in range(1, 8)]
    sizes = dict(zip(days, (50, 10, 20, 30, 100, 5, 5)))
    by_bytes = jobs.day_batches(sizes, max_bytes=60)
    assert sorted(d for b in by_bytes for d in b) == days
    assert [b for b in by_bytes if sum(sizes[d] for d in b) > 60] == [[days[4]]] and len(by_bytes) == 3
    by_days = jobs.day_batches(sizes, max_days=2)
    assert max(map(len, by_days)) == 2 and sorted(d for b in by_days for d in b) == days and len(by_days) == 4
    assert jobs.day_batches(sizes) == [days] and jobs.day_batches({}) == []


def test_two_checkpoints_of_a_day_keep_their_rows(spark, tmp_path):
    delta, src = str(tmp_path / "delta"), str(tmp_path / "src")
    schema = "value binary, partition int, offset bigint"
    ingest = lambda frame, run: jobs.ingest_metrics(frame, run, delta)
    for n, day in ((1, "2024-01-01"), (2, "2024-01-01")):
        _feed(spark, [_metric(f"u{n}", "2024-01-01", n)]).write.parquet(f"{src}{n}")
        feeds.drain(kafka.file_feed(spark, f"{src}{n}", schema), jobs.ingest_handler(ingest, day, "m", "g", f"{tmp_path}/cp{n}"), f"{tmp_path}/cp{n}")
    assert sorted(r["likes"] for r in tables.read_delta(spark, delta, "2024-01-01").collect()) == [1, 2]
    # a repeat of a batch on a later day replaces the rows of the day it was first tried on
    again = jobs.ingest_handler(ingest, "2024-01-02", "m", "g", f"{tmp_path}/cp2")
    again(spark.read.parquet(f"{src}2"), 0)
    assert tables.read_delta(spark, delta, "2024-01-02") is None and tables.read_delta(spark, delta, "2024-01-01").count() == 2


def test_history_of_repeated_posts_is_cut_through_the_job(spark, feeds_of):
    place, ingest, merge = feeds_of
    rows = [("p", "old", "t1", "t1", "2024-01-02"), ("p", "newer", "t2", "t2", "2024-01-02"), ("q", "null first", None, "t0", "2024-01-02"), ("q", "kept", "t0", None, "2024-01-02")]
    old = spark.createDataFrame(rows, "PostId string, Url string, MetricsTimestamp string, CreateDate string, partdate string")
    sinks.replace_partitions(old.withColumn("partdate", F.to_date("partdate")), place("Posts"), ["partdate"])
    ingest("2024-01-03", [_post("x", "2024-01-02")])
    merge("2024-01-03", history_unique=False)
    assert {r["PostId"]: r["Url"] for r in spark.read.parquet(place("Posts")).collect()} == {"p": "newer", "q": "kept", url_key_of("x"): "x"}


def test_touched_files_of_posts_only(spark, feeds_of):
    place, ingest, merge = feeds_of
    ingest("2024-01-03", [_post(f"u{n}", "2024-01-02", n) for n in range(20)])
    merge("2024-01-03")
    ingest("2024-01-04", [_post("u3", "2024-01-02", 99)])
    merge("2024-01-04", touched_only=True)
    rows = {r["Url"]: r["MetricsLikesCount"] for r in spark.read.parquet(place("Posts")).collect()}
    assert rows["u3"] == 99 and len(rows) == 20 and rows["u5"] == 5
