"""The jobs, from message envelope to accumulated tables.

Ingest jobs take an envelope frame ``value, partition, offset`` and serve a
batch read of a feed as well as one micro-batch of a stream. The schema is
inferred from each batch unless one is given; then a message that does not fit
it counts as unreadable.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.functions.classify import classify_url
from feedfold.functions.dates import as_date
from feedfold.functions.keys import KeyFn, url_key
from feedfold.operators import merge
from feedfold.operators.matching import match_rows
from feedfold.operators.offsets import run_offsets
from feedfold.operators.reshape import canonical_metrics, derive_post_dates, project_metrics
from feedfold.operators.schema import (
    METRICS_SCHEMA,
    RESCUED,
    UNPARSED,
    dedupe_columns,
    find_field,
    parse_json_rows,
    quoted,
    survey_json,
    union_drift,
)
from feedfold.operators.split import CHILD_PARTS, PRIMARY, FieldPolicy, split_posts, transform_blogs
from feedfold.session import staging_path
from feedfold.sources import sinks, tables
from feedfold.sources.files import Store
from feedfold.sources.leftout import Held, keep_left_out
from feedfold.sources.retention import contents, note_consumed
from feedfold.sources.swap import settle
from feedfold.sources.touched import rewrite_touched
from feedfold.streaming.feeds import BatchHandler

POSTS_PARTITION = "partdate"


@dataclass(frozen=True)
class Run:
    """One run of a job."""

    exec_date: str
    exec_time: str
    topic: str = ""
    group: str = ""

    @classmethod
    def now(cls, exec_date: str, topic: str = "", group: str = "") -> Run:
        return cls(exec_date, datetime.now().strftime("%H-%M"), topic, group)


# --- ingest ----------------------------------------------------------------

@dataclass(frozen=True)
class Parsed:
    """Messages of one batch: the raw copy, the readable ones flat, the others as text."""

    raw: DataFrame
    messages: DataFrame
    unreadable: DataFrame


def parse_messages(
    envelope: DataFrame, target: str, required: str, schema: T.StructType | None = None
) -> Parsed:
    """Stage a batch of messages for a target table, infer their schema and parse them.

    A message without its ``required`` field could not be keyed, and counts as
    unreadable.

    The feed is read once, into the shared folder: inference, parsing and the
    ledger then see the same messages even if more have arrived since. The
    parsed copy keeps the test for readable rows, and every later reader, from
    parsing the text again.
    """
    spark = envelope.sparkSession
    raw = sinks.stage(
        envelope.select(
            F.col("value").cast("string").alias("value"),
            F.col("partition").alias("kafkapartition"),
            F.col("offset").alias("kafkaoffset"),
        ),
        staging_path(spark, "raw", target),
    )
    fields, sound = (schema, False) if schema is not None else survey_json(raw)
    key = find_field(fields, required)
    readable = F.lit(False)
    if key is not None:
        readable = F.col(f"_json.{UNPARSED}").isNull() & quoted("_json", key.name).isNotNull()
    flagged = parse_json_rows(raw, fields, sound=sound).withColumns({"_readable": readable, "_loaded": F.current_timestamp()})
    # the text of a readable message is not needed twice
    parsed = sinks.stage(
        flagged.withColumn("value", F.when(~F.col("_readable"), F.col("value"))), staging_path(spark, "parsed", target)
    )
    messages = dedupe_columns(
        parsed.where("_readable").select("kafkapartition", "kafkaoffset", "_loaded", "_json.*")
    ).drop(UNPARSED)
    messages = messages.withColumn("CurrentTimestamp", F.col("_loaded")).drop("_loaded")
    return Parsed(raw, messages, parsed.where("NOT _readable").select("value", "kafkapartition", "kafkaoffset"))


def _finish_ingest(
    parsed: Parsed, run: Run, dead_letters: str | None, ledger: str | None, rescued: DataFrame | None = None
) -> None:
    """Data is in place by now; dead letters and the ledger follow, in this order.

    Dead letters are unreadable messages as they came, and, of those that were read but for some values, these values.
    """
    if dead_letters:
        letters = parsed.unreadable.withColumn("reason", F.lit("unreadable"))
        if rescued is not None:
            letters = letters.unionByName(rescued.withColumn("reason", F.lit("unfit")))
        sinks.write_delta(letters, dead_letters, run.exec_date, run.exec_time)
    if ledger:
        offsets = run_offsets(parsed.raw, run.topic, run.group, run.exec_date, run.exec_time)
        sinks.append_ledger(offsets, ledger)


def ingest_blogs(
    envelope: DataFrame,
    run: Run,
    policy: FieldPolicy,
    base: str,
    ledger: str | None = None,
    dead_letters: str | None = None,
    mode: str = "exclude",
    key: str = "UrlHash",
    schema: T.StructType | None = None,
) -> None:
    """Blog messages to the blog delta."""
    parsed = parse_messages(envelope, base, key, schema)
    sinks.write_delta(transform_blogs(parsed.messages, policy, mode), base, run.exec_date, run.exec_time)
    _finish_ingest(parsed, run, dead_letters, ledger)


def flat_metrics(messages: DataFrame, exec_date: str, key_fn: KeyFn = url_key) -> DataFrame:
    """Metrics messages as the 17 delta columns, and ``_rescued``, a map of the values that these cannot take, or null."""
    return project_metrics(messages, rescue=True).withColumns(
        {"id": key_fn(F.col("metricsurl")), "execdate": F.lit(exec_date)}
    )


def ingest_metrics(
    envelope: DataFrame,
    run: Run,
    base: str,
    ledger: str | None = None,
    dead_letters: str | None = None,
    key_fn: KeyFn = url_key,
    schema: T.StructType | None = None,
) -> None:
    """Metrics messages to the metrics delta; values that do not fit its columns are kept beside them and in the dead letters."""
    parsed = parse_messages(envelope, base, "Url", schema)
    flat = flat_metrics(parsed.messages, run.exec_date, key_fn)
    sinks.write_delta(flat, base, run.exec_date, run.exec_time)
    unfit = flat.where(F.col(RESCUED).isNotNull()).select(F.to_json(RESCUED).alias("value"), "kafkapartition", "kafkaoffset")
    _finish_ingest(parsed, run, dead_letters, ledger, unfit)


def keyed_posts(messages: DataFrame, key_fn: KeyFn = url_key) -> DataFrame:
    """Post messages with key and dates."""
    if find_field(messages.schema, "CreateDate") is None:
        messages = messages.withColumn("CreateDate", F.lit(None).cast("string"))
    return derive_post_dates(messages).withColumn("Id", key_fn(F.col("Url")))


def ingest_posts(
    envelope: DataFrame,
    run: Run,
    policy: FieldPolicy,
    bases: Callable[[str], str],
    ledger: str | None = None,
    dead_letters: str | None = None,
    key_fn: KeyFn = url_key,
    schema: T.StructType | None = None,
) -> None:
    """Post messages to five deltas; ``bases`` names the table of each part."""
    parsed = parse_messages(envelope, bases(PRIMARY), "Url", schema)
    posts = keyed_posts(parsed.messages, key_fn)
    parts = split_posts(posts, policy, run.exec_date)
    write = inheritable_thread_target(posts.sparkSession)(
        lambda name: sinks.write_delta(parts[name], bases(name), run.exec_date, run.exec_time)
    )
    # five writes over one staged copy; together they keep the cluster busy
    with ThreadPoolExecutor(len(parts)) as pool:
        list(pool.map(write, parts))
    _finish_ingest(parsed, run, dead_letters, ledger)


def ingest_handler(
    ingest: Callable[[DataFrame, Run], None], exec_date: str, topic: str, group: str, checkpoint: str
) -> BatchHandler:
    """An ingest job as the handler of a stream drained with the given checkpoint.

    The run label is the stream's own id, which its checkpoint keeps, and the batch id, so that neither another stream nor a new checkpoint
    meets its rows on the same day. A batch's day is fixed when it is first tried, in a record beside the checkpoint: a repeat on a later
    day replaces the same rows.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession, checkpoint)
        record = f"{checkpoint}/runs/{batch_id}"
        store.write_new(record, {"exec_date": exec_date})
        day = store.read(record)["exec_date"]
        stream = store.read(f"{checkpoint}/metadata")["id"].replace("-", "")
        ingest(batch, Run(day, f"{stream}-{batch_id:08d}", topic, group))

    return handle


# --- merge -----------------------------------------------------------------

@dataclass(frozen=True)
class Upkeep:
    """What a merge does besides merging.

    ``left_out`` keeps rows outside the window, a folder per feed, and has those read again that the window admits; ``days`` gives
    undated ones a day (Id, PartDate). ``consumed`` is the ledger of folded runs, ``consumer`` the merge's name in it. ``owner``
    names the run, so that its repeat may go on where a lost driver stopped.
    """

    left_out: str | None = None
    days: DataFrame | None = None
    consumed: str | None = None
    consumer: str | None = None
    owner: str | None = None


def merge_blogs(
    spark: SparkSession,
    exec_date: str | date,
    blogs: str,
    snapshots: str,
    clusters: int | None = None,
    key: str = "UrlHash",
    upkeep: Upkeep = Upkeep(),
) -> None:
    """A day's blog delta over the newest older snapshot, as that day's snapshot.

    The snapshot is written in ``clusters`` buckets by key hash; unless given, in as many as the older one has, or the
    number of shuffle partitions the cluster is set to. Since the older one remembers its layout, only the delta is shuffled. Without any older
    snapshot the delta alone is the snapshot; history that cannot be read is an error.
    """
    settle(spark, snapshots, upkeep.owner)
    runs = tables.delta_runs(spark, blogs, exec_date)
    seen = contents(spark, runs) if upkeep.consumed else {}
    delta = tables.read_delta(spark, blogs, exec_date, runs=runs)
    folder = tables.latest_snapshot_folder(spark, snapshots, exec_date)
    if delta is None and folder is None:
        return
    history, layout = None, None
    if folder is not None:
        history, layout = tables.read_snapshot(spark, folder).drop("partition_key"), tables.layout_of(spark, folder)
    keys = ["AccountId"]
    known = layout["buckets"] if layout and layout["keys"] == keys else None
    clusters = clusters or known or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order, tiebreak = ["CurrentTimestamp", "MergeDate"], ["kafkaoffset", "kafkapartition"]
    if delta is None:
        merged = sinks.cluster_by(history, clusters, keys)
    else:
        delta = delta.drop("exec_date", "exec_time").withColumns(
            {"MergeDate": F.lit(as_date(exec_date).strftime("%Y%m%d")), "AccountId": F.col(key)}
        )
        if history is None:
            merged = merge.latest_per_key(sinks.cluster_by(delta, clusters, keys), keys, order, tiebreak=tiebreak)
        else:
            merged = merge.snapshot_merge(history, delta, keys, order, tiebreak, clusters, laid_out=known == clusters)
    sinks.write_snapshot(merged, snapshots, exec_date, keys=keys, buckets=clusters, owner=upkeep.owner)
    if upkeep.consumed:
        note_consumed(spark, upkeep.consumed, upkeep.consumer or f"blogs:{snapshots}", seen)


@dataclass(frozen=True)
class MergeReport:
    """Days a merge rewrote, and rows outside its date window."""

    days: list[date]
    outside: int


def day_batches(sizes: Mapping[date, int], max_days: int | None = None, max_bytes: int | None = None) -> list[list[date]]:
    """Days in batches of at most ``max_days`` days and ``max_bytes`` together, sorted; a day above that is a batch of its own.

    The largest days are placed first, each into the emptiest batch that takes it, so batches come out even.
    """
    batches: list[list[date]] = []
    held: list[int] = []
    for day in sorted(sizes, key=lambda d: (-sizes[d], d)):
        fits = [
            i for i, b in enumerate(batches)
            if len(b) < (max_days or len(sizes)) and (max_bytes is None or held[i] + sizes[day] <= max_bytes)
        ]
        if fits and (max_days or max_bytes):
            at = min(fits, key=lambda i: (held[i], i))
        elif fits:
            at = 0
        else:
            batches.append([])
            held.append(0)
            at = len(batches) - 1
        batches[at].append(day)
        held[at] += sizes[day]
    return sorted(sorted(b) for b in batches)


class _Input:
    """One delta of a merge: its runs as found, and the rows once left out that the window admits."""

    def __init__(self, spark: SparkSession, base: str, name: str, exec_date: str | date, lower: str | date, upkeep: Upkeep, fmt: str = "parquet"):
        self._spark, self._upkeep, self._lower, self._upper = spark, upkeep, lower, exec_date
        runs = tables.delta_runs(spark, base, exec_date)
        self._seen = contents(spark, runs) if upkeep.consumed else {}
        self._own = tables.read_delta(spark, base, exec_date, fmt, runs)
        if self._own is not None:
            self._own = merge.with_day(self._own)
        self._place = f"{upkeep.left_out}/{name}" if upkeep.left_out else None
        self._held = Held(spark, self._place, lower, exec_date, days=upkeep.days) if self._place else None

    def rows(self) -> DataFrame | None:
        again = self._held.admitted() if self._held else None
        frames = [f.drop("exec_date", "exec_time") for f in (self._own, again) if f is not None]
        return merge.with_day(union_drift(*frames)) if frames else None

    def done(self, consumer: str) -> None:
        """The rows are in their table: keep what was left out, let go of what was admitted, note the runs, in this order."""
        if self._place and self._own is not None:
            self._held.release()
            keep_left_out(self._own, self._place, self._lower, self._upper)
        elif self._place:
            self._held.release()
        if self._upkeep.consumed:
            note_consumed(self._spark, self._upkeep.consumed, self._upkeep.consumer or consumer, self._seen)


def merge_posts(
    spark: SparkSession,
    exec_date: str | date,
    lower: str | date,
    posts: str,
    metrics: str,
    merged: str,
    key_fn: KeyFn = url_key,
    fmt: str = "parquet",
    max_days: int | None = None,
    rebalance: bool = True,
    max_bytes: int | None = None,
    touched_only: bool = False,
    history_unique: bool = True,
    upkeep: Upkeep = Upkeep(),
) -> MergeReport:
    """A day's posts and metrics into the merged posts table.

    All touched days are merged in one plan and written at once; ``max_days`` and ``max_bytes`` (of the days as they are)
    bound what one write replaces where a cluster is small. ``touched_only`` rewrites the files that hold changed posts instead of whole days.
    Rebalancing sizes the files at the cost of a shuffle; a table so large that every task fills a
    file per day can do without.

    A post has one row. Where its newest message has another day than the table's row, that row moves to the new day, its values under the message's.
    Only a table filled from elsewhere may repeat a post on a day; ``history_unique=False`` cuts it to the newest row.
    """
    settle(spark, merged, upkeep.owner)
    inputs = [_Input(spark, base, name, exec_date, lower, upkeep, fmt) for base, name in ((posts, "posts"), (metrics, "metrics"))]
    post_rows, metric_rows = (i.rows() for i in inputs)
    if post_rows is None and metric_rows is None:
        return MergeReport([], 0)
    metric_rows = spark.createDataFrame([], METRICS_SCHEMA) if metric_rows is None else metric_rows
    metric_rows = merge.with_day(canonical_metrics(metric_rows))
    post_rows = spark.createDataFrame([], merge.POST_COLUMNS) if post_rows is None else post_rows
    days, outside = merge.window_profile([post_rows, metric_rows], "PartDate", lower, exec_date)
    joined = merge.join_posts_metrics(post_rows, metric_rows, lower, exec_date)
    window = _window_days(spark, merged, lower, exec_date)
    # rows of metrics alone have no Url and stay where they are
    moved = _moved(spark, merged, window, merge.newest_posts(post_rows, lower, exec_date), fmt, "Url IS NOT NULL")
    carried = None
    if moved is not None:
        left = [r[0] for r in moved.select("Partdate").distinct().collect()]
        days = sorted({*days, *left})
        old = tables.read_partitions(spark, merged, POSTS_PARTITION, left, fmt).withColumnRenamed(POSTS_PARTITION, "Partdate")
        carried = sinks.stage(merge.carried_rows(old, moved), staging_path(spark, "carried", merged))
    store = Store(spark, merged)
    sizes = {d: sum(store.files(f"{merged}/{POSTS_PARTITION}={d.isoformat()}").values()) for d in days}
    batches = day_batches(sizes, max_days, max_bytes)
    if len(batches) > 1 or touched_only:
        # by day, so that a batch reads its own days' files
        joined = sinks.stage(joined, staging_path(spark, "joined", merged), by="PartdatePmd")
    network = classify_url("Url")  # one expression for all batches
    for some in batches:
        delta = joined.where(F.col("PartdatePmd").isin(some)) if len(batches) > 1 else joined

        def laid(history: DataFrame | None, some: list[date] = some, delta: DataFrame = delta) -> DataFrame:
            unique = history_unique
            if carried is not None:
                history = merge.without_moved(history, moved, carried.where(F.col("Partdate").isin(some)), POSTS_PARTITION)
                unique = False
            table = merge.upsert_posts(history, delta, key_fn, classify=lambda _: network, history_unique=unique)
            return table.withColumnRenamed("Partdate", POSTS_PARTITION)

        if touched_only and carried is None:
            changed = delta.select("PostId", F.col("PartdatePmd").alias(POSTS_PARTITION))
            rewrite_touched(spark, merged, POSTS_PARTITION, some, ["PostId", POSTS_PARTITION], changed, laid, fmt, owner=upkeep.owner)
        else:
            history = tables.read_partitions(spark, merged, POSTS_PARTITION, some, fmt)
            table = laid(history)
            emptied = [] if carried is None else [d for d in some if d in window]
            sinks.replace_partitions(table, merged, [POSTS_PARTITION], rebalance, fmt=fmt, owner=upkeep.owner, also=[f"{POSTS_PARTITION}={d.isoformat()}" for d in emptied])
    for i in inputs:
        i.done(f"posts:{merged}")
    return MergeReport(days, outside)


def _window_days(spark: SparkSession, table: str, lower: str | date, upper: str | date) -> list[date]:
    """Days of a window that a dated table has."""
    days = [as_date(n.partition("=")[2]) for n in Store(spark, table).names(table) if n.startswith(f"{POSTS_PARTITION}=")]
    return sorted(d for d in days if as_date(lower) <= d <= as_date(upper))


def _moved(spark: SparkSession, table: str, window: list[date], posts: DataFrame, fmt: str = "parquet", only: str | None = None) -> DataFrame | None:
    """Keys of a table's rows, ``only`` some, whose post is on another day by ``posts`` (Id, PartDate); staged, None if there are none."""
    if not window:
        return None
    # a given schema: narrow columns, and no footer is read to merge schemas
    folders = [f"{table}/{POSTS_PARTITION}={d.isoformat()}" for d in window]
    known = spark.read.schema(f"PostId string, Url string, {POSTS_PARTITION} date").option("basePath", table).format(fmt).load(folders)
    keys = (known.where(only) if only else known).select("PostId", F.col(POSTS_PARTITION).alias("Partdate"))
    moved = sinks.stage(merge.moved_keys(keys, posts), staging_path(spark, "moved", table))
    return None if moved.isEmpty() else moved


def merge_child_table(
    spark: SparkSession,
    exec_date: str | date,
    lower: str | date,
    children: str,
    merged_posts: str,
    table: str,
    ties: str = "all",
    rebalance: bool = True,
    upkeep: Upkeep = Upkeep(),
) -> MergeReport:
    """A day's child rows of one kind into their table.

    Rows of a post that has moved to another day go from the old one. Child rows in the window whose post is not in the merged table
    have nothing to belong to and are not kept.
    """
    settle(spark, table, upkeep.owner)
    source = _Input(spark, children, children.rstrip("/").rpartition("/")[2], exec_date, lower, upkeep)
    delta = source.rows()
    if delta is None:
        return MergeReport([], 0)
    days, outside = merge.window_profile([delta], "PartDate", lower, exec_date)
    posts = tables.read_partitions(spark, merged_posts, POSTS_PARTITION, days)
    if days and posts is not None:
        window = _window_days(spark, table, lower, exec_date)
        of_posts = posts.where("Url IS NOT NULL").select(F.col("PostId").alias("Id"), F.col(POSTS_PARTITION).alias("PartDate"))
        stale = _moved(spark, table, window, of_posts)
        if stale is not None:
            days = sorted({*days, *(r[0] for r in stale.select("Partdate").distinct().collect())})
        history = tables.read_partitions(spark, table, POSTS_PARTITION, days)
        if history is not None:
            history = history.withColumnRenamed(POSTS_PARTITION, "Partdate")
            history = history if stale is None else match_rows(history, stale, merge.POST_KEY, "left_anti")
        emptied = [] if stale is None else [f"{POSTS_PARTITION}={d.isoformat()}" for d in days if d in window]
        stage = lambda keys: sinks.stage(keys, staging_path(spark, "wanted", table))
        merged = merge.merge_children(history, delta, posts, lower, exec_date, ties=ties, stage=stage)
        sinks.replace_partitions(
            merged.withColumnRenamed("Partdate", POSTS_PARTITION), table, [POSTS_PARTITION], rebalance, owner=upkeep.owner, also=emptied
        )
    source.done(f"children:{table}")
    return MergeReport(days if posts is not None else [], outside)


def merge_all_children(
    spark: SparkSession,
    exec_date: str | date,
    lower: str | date,
    bases: Callable[[str], str],
    tables_of: Callable[[str], str],
    upkeep: Upkeep = Upkeep(),
) -> dict[str, MergeReport]:
    """The four child tables, one after another."""
    return {
        part: merge_child_table(spark, exec_date, lower, bases(part), tables_of(PRIMARY), tables_of(part), upkeep=upkeep)
        for part in CHILD_PARTS
    }
