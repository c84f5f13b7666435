"""Folding a delta into what has been accumulated."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.functions.classify import classify_url
from feedfold.functions.dates import as_date, text_to_date
from feedfold.functions.keys import KeyFn, url_key
from feedfold.operators.latest import latest_per_key, newest_versions, rows_of_versions
from feedfold.operators.matching import match_rows
from feedfold.operators.reshape import suffix_collisions
from feedfold.operators.schema import align_column, align_to, backquoted, exact_schema, find_field, quoted, union_drift, widen

# --- date window -----------------------------------------------------------


def in_window(column: Column | str, lower: str | date, upper: str | date) -> Column:
    """Closed day interval. Left bare of null handling, so a scan can use it."""
    day = quoted(column) if isinstance(column, str) else column
    return day.between(F.lit(as_date(lower)), F.lit(as_date(upper)))


def left_out_reason(column: Column | str, lower: str | date, upper: str | date) -> Column:
    """Why a row is outside a day interval: undated, late or early; null for a row inside."""
    day = quoted(column) if isinstance(column, str) else column
    late, early = day < F.lit(as_date(lower)), day > F.lit(as_date(upper))
    return F.when(day.isNull(), F.lit("undated")).when(late, F.lit("late")).when(early, F.lit("early"))


def window_profile(
    frames: Sequence[DataFrame], column: str, lower: str | date, upper: str | date
) -> tuple[list[date], int]:
    """Days of the window that occur in any frame, sorted, and the count of rows outside it.

    One aggregation over one column per frame. What reaches the driver is a
    single row with at most one entry per day of the window. Rows without a
    day count as outside.
    """
    days: set[date] = set()
    outside = 0
    for df in frames:
        inside = F.coalesce(in_window(column, lower, upper), F.lit(False))
        row = df.agg(
            F.collect_set(F.when(inside, quoted(column))).alias("days"),
            F.count_if(~inside).alias("outside"),
        ).first()
        days.update(row["days"])
        outside += row["outside"]
    return sorted(days), outside


# --- keyed snapshot --------------------------------------------------------

def unchanged_history(history: DataFrame, delta: DataFrame, keys: Sequence[str], clustered: bool = False) -> DataFrame:
    """History rows whose key the delta does not have; a row without a key is nobody's and stays.

    ``clustered`` asks Spark to meet both sides by key hash, which a side laid out that way needs no exchange for.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    wanted = delta.select(*(quoted(k).alias(n) for k, n in zip(keys, names)))
    same = [quoted(k) == F.col(n) for k, n in zip(keys, names)]
    return history.join(wanted.hint("merge") if clustered else wanted, reduce(Column.__and__, same), "left_anti")


def snapshot_merge(
    history: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] | None = None,
    clusters: int | None = None,
    laid_out: bool = False,
) -> DataFrame:
    """The newest delta row of each key, and all history rows of other keys.

    A delta row replaces history rows as a whole. Columns and types may
    differ between the two sides. Rows without a key replace nothing: history's stay, and of the delta's the newest is added.

    Spark broadcasts the delta's keys where they turn out small. With ``clusters`` the
    result has that many partitions by key hash, ready to be written as such, and
    the same rows. Then history is ``laid_out`` that way already, as ``read_snapshot`` gives it, and only the delta is
    shuffled; or it goes through one exchange, which serves the layout, too.
    """
    if clusters:
        delta = delta.repartition(clusters, *(quoted(k) for k in keys))
        if not laid_out:
            history = history.repartition(clusters, *(quoted(k) for k in keys))
    newest = latest_per_key(delta, keys, order, tiebreak=tiebreak)
    return union_drift(unchanged_history(history, newest, keys, bool(clusters)), newest)


# --- column-wise upsert ----------------------------------------------------

def first_present(df: DataFrame, names: Sequence[str], default: T.DataType) -> Column:
    """First non-null of the columns the frame has, in a type all of them fit in.

    A frame with none of them gives nulls of the default type.
    """
    own = [f for n in names if (f := find_field(df.schema, n)) is not None]
    if not own:
        return F.lit(None).cast(default)
    dtype = reduce(widen, (f.dataType for f in own))
    return F.coalesce(*(align_column(quoted(f.name), f.dataType, dtype) for f in own))


def greatest_present(df: DataFrame, names: Sequence[str], default: T.DataType) -> Column:
    """Greatest of the columns the frame has, nulls passed over."""
    own = [f for n in names if (f := find_field(df.schema, n)) is not None]
    if not own:
        return F.lit(None).cast(default)
    dtype = reduce(widen, (f.dataType for f in own))
    values = [align_column(quoted(f.name), f.dataType, dtype) for f in own]
    return F.greatest(*values) if len(values) > 1 else values[0]


def coalesce_merge(history: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join by key; each column is the delta's value, or history's where that is null.

    Each side must hold a key once. Nulls in keys are equal, so a repeated merge gives the same rows. Columns of
    one side only are kept.
    """
    target = exact_schema(history, delta)
    # as text: a call per column costs a plan that is built batch by batch more than its jobs
    old, new = (align_to(f, target).toDF(*(f"_{side}{i}" for i in range(len(target.fields)))) for f, side in ((history, "h"), (delta, "d")))
    at = {f.name.lower(): i for i, f in enumerate(target.fields)}
    on = F.expr(" AND ".join(f"_h{at[k.lower()]} <=> _d{at[k.lower()]}" for k in keys))
    merged = (f"coalesce(_d{i}, _h{i}) AS {backquoted(f.name)}" for i, f in enumerate(target.fields))
    return old.join(new, on, "full_outer").selectExpr(*merged)


# --- posts and metrics -----------------------------------------------------

# Count column -> columns to take it from, the stream's before the embedded.
COUNT_SOURCES: dict[str, tuple[str, str]] = {
    "CommentsCount": ("Comments", "MetricsCommentCount"),
    "LikesCount": ("Likes", "MetricsLikeCount"),
    "RepostsCount": ("Reposts", "MetricsRepostCount"),
    "ViewsCount": ("Views", "MetricsViewCount"),
}

# Merged column -> (column of the joined delta, type where no data has it).
MERGED_COLUMNS: dict[str, tuple[str, str]] = {
    "AuthorUrl": ("AuthorUrl", "string"),
    "BlogansLanguage": ("BlogansLanguage", "bigint"),
    "BlogType": ("BlogType", "bigint"),
    "CreateDate": ("CreateDate", "string"),
    "MetricsCommentsCount": ("MetricsCommentCount", "bigint"),
    "IsSpam": ("IsSpam", "boolean"),
    "MetricsLikesCount": ("LikesCount", "bigint"),
    "ParentUrlHash": ("ParentUrlHash", "string"),
    "Type": ("Type", "bigint"),
    "Url": ("Url", "string"),
    "PostNerObjects": (
        "PostNerObjects",
        "array<struct<Id:bigint,Name:string,ObjectType:bigint,ObjectTypeStr:string,"
        "Positions:array<string>,PositionsInTitle:array<string>,"
        "PositionsInTitleNer:array<struct<Length:bigint,Start:bigint>>,"
        "PositionsNer:array<struct<Length:bigint,Start:bigint>>>>",
    ),
    "PostNHObjects": (
        "PostNHObjects",
        "array<struct<BranchId:bigint,ObjectId:bigint,OpinionId:bigint,"
        "Positions:array<struct<Length:bigint,Start:bigint>>,Positions2:array<string>,Tonality:bigint>>",
    ),
    "MetricsRepostsCount": ("MetricsRepostCount", "bigint"),
    "AuthorProviderType": ("AuthorProviderType", "bigint"),
    "Topics": ("Topics", "array<struct<Id:bigint,key:string,value:double>>"),
    "MetricsViewsCount": ("MetricsViewCount", "bigint"),
    "CurrentTimestamp": ("CurrentTimestamp", "timestamp"),
    "MetricsTimestamp": ("MetricsTimestamp", "string"),
    "BlogUrl": ("BlogUrl", "string"),
    "CommentNegativeCount": ("CommentNegativeCount", "bigint"),
    "CommentPositiveCount": ("CommentPositiveCount", "bigint"),
    "CurrentTimestampMetrics": ("CurrentTimestampMetrics", "timestamp"),
    "ExecDate": ("ExecDate", "string"),
    "Partdate": ("PartdatePmd", "date"),
    "PostId": ("PostId", "string"),
    "CommentsCount": ("CommentsCount", "bigint"),
    "RepostsCount": ("RepostsCount", "bigint"),
}

# What a posts delta holds at the least.
POST_COLUMNS = T.StructType(
    [
        T.StructField("Id", T.StringType()),
        T.StructField("PartDate", T.DateType()),
        T.StructField("Url", T.StringType()),
        T.StructField("CurrentTimestamp", T.TimestampType()),
    ]
)

POST_KEY = ("PostId", "Partdate")
NEWEST_POST = ("MetricsTimestamp", "CurrentTimestamp")


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [f.name for n in names if (f := find_field(df.schema, n)) is not None]


def with_day(df: DataFrame, column: str = "PartDate") -> DataFrame:
    """The frame with its day column as a date, whatever text it came as."""
    field = find_field(df.schema, column)
    if isinstance(field.dataType, T.DateType):
        return df
    return df.withColumn(field.name, text_to_date(quoted(field.name)))


def newest_posts(posts: DataFrame, lower: str | date, upper: str | date) -> DataFrame:
    """The newest message of each post in a window, whose day is the post's."""
    posts = with_day(posts).where(in_window("PartDate", lower, upper))
    return latest_per_key(
        posts,
        ["Id"],
        _present(posts, ["MetricsTimestamp", "CurrentTimestamp"]),
        tiebreak=_present(posts, ["kafkaoffset", "kafkapartition"]) or None,
    )


def moved_keys(known: DataFrame, posts: DataFrame) -> DataFrame:
    """PostId, Partdate and new day of the known rows (PostId, Partdate) whose post is now on another day. ``posts`` have an id once."""
    now = posts.select(F.col("Id").alias("PostId"), F.col("PartDate").alias("_day"))
    return known.join(now, "PostId").where("Partdate <> _day").distinct()


def carried_rows(history: DataFrame, moved: DataFrame) -> DataFrame:
    """History rows of moved posts, under their new day."""
    return history.join(moved, ["PostId", "Partdate"]).withColumn("Partdate", F.col("_day")).drop("_day").select(*history.columns)


def without_moved(history: DataFrame | None, moved: DataFrame, carried: DataFrame, partition: str) -> DataFrame:
    """History of some days without the rows that moved away, and with those that moved there; its day column named as in the rows."""
    if history is None:
        return carried
    stay = match_rows(history.withColumnRenamed(partition, "Partdate"), moved, POST_KEY, "left_anti")
    return union_drift(stay, carried)


def join_posts_metrics(
    posts: DataFrame, metrics: DataFrame, lower: str | date, upper: str | date
) -> DataFrame:
    """Posts with the newest metrics of the same day, one row per (id, day).

    The newest message of a post settles its day. A post without metrics and
    metrics without a post of their day both stay: metrics dated another day
    are a row of that day. Posts are cut to one row per id and metrics to one
    per (id, day) before the join, so each pair has unique keys, and no window
    over the joined rows follows.
    """
    metrics = with_day(metrics).where(in_window("PartDate", lower, upper))
    posts = newest_posts(posts, lower, upper)
    metrics = latest_per_key(
        metrics,
        ["Id", "PartDate"],
        _present(metrics, ["MetricsTimestamp", "CurrentTimestamp"]),
        tiebreak=_present(metrics, ["KafkaOffset", "KafkaPartition"]) or None,
    )
    metrics = suffix_collisions(metrics, posts.columns, "Metrics")
    joined = posts.join(
        metrics,
        (F.col("Id") == F.col("IdMetrics")) & (F.col("PartDate") == F.col("PartDateMetrics")),
        "full_outer",
    )
    derived = {
        "PartdatePmd": F.coalesce(F.col("PartDate"), F.col("PartDateMetrics")),
        "PostId": F.coalesce(F.col("Id"), F.col("IdMetrics")),
        "MetricsTimestamp": greatest_present(joined, ["MetricsTimestamp", "MetricsTimestampMetrics"], T.StringType()),
        **{out: first_present(joined, sources, T.LongType()) for out, sources in COUNT_SOURCES.items()},
    }
    working = {"id", "idmetrics", "partdate", "partdatemetrics", "metricstimestamp", "metricstimestampmetrics"}
    working |= {stream.lower() for stream, _ in COUNT_SOURCES.values()}
    rest = [quoted(c) for c in joined.columns if c.lower() not in working]
    return joined.select(*rest, *(c.alias(n) for n, c in derived.items()))


def merged_post_columns(
    delta: DataFrame,
    columns: Mapping[str, tuple[str, str]] = MERGED_COLUMNS,
    key_fn: KeyFn = url_key,
) -> DataFrame:
    """The joined delta under the merged table's column names.

    The same names serve the first run and all later ones.
    """
    parent = find_field(delta.schema, "ParentUrl") if "ParentUrlHash" in columns else None
    sources = {}
    for name, (source, default) in columns.items():
        own = find_field(delta.schema, source)
        sources[name] = f"CAST(NULL AS {default})" if own is None else backquoted(own.name)
    if parent is not None:
        url, known = quoted(parent.name), F.expr(sources["ParentUrlHash"])
        delta = delta.withColumn("_parent_hash", F.when(url.isNotNull(), key_fn(url)).otherwise(known))
        sources["ParentUrlHash"] = "_parent_hash"
    return delta.selectExpr(*(f"{value} AS {backquoted(name)}" for name, value in sources.items()))


def upsert_posts(
    history: DataFrame | None,
    delta: DataFrame,
    key_fn: KeyFn = url_key,
    classify: KeyFn = classify_url,
    columns: Mapping[str, tuple[str, str]] = MERGED_COLUMNS,
    history_unique: bool = False,
) -> DataFrame:
    """Merged posts of the delta's days: each value the delta's, else history's.

    ``delta`` comes from :func:`join_posts_metrics` and holds a post and day once;
    ``history`` holds the touched days, or is None. Unless it is known to hold
    a post once, as a table written from here does, it is cut to the newest
    row per key on the partitioning the join needs anyway. Columns only
    history has are kept.
    """
    new = merged_post_columns(delta, columns, key_fn)
    if history is None:
        old = new.sparkSession.createDataFrame([], new.schema)
    else:
        old = history.drop("SocialnetworkType")
        old = align_to(old, exact_schema(new, old))
    if history is not None and not history_unique:
        old = latest_per_key(old, POST_KEY, NEWEST_POST, tiebreak=["Url", "ExecDate"])
    return coalesce_merge(old, new, POST_KEY).withColumn("SocialnetworkType", classify(F.col("Url")))


# --- child rows ------------------------------------------------------------

CHILD_KEY = ("Id", "PartDate")


def version_columns(children: DataFrame) -> list[str]:
    """What tells the versions of a post apart, as far as the rows carry it."""
    return _present(children, ["PostCreateDate", "CurrentTimestamp", "kafkaoffset", "kafkapartition"])


def children_of_posts(children: DataFrame, posts: DataFrame) -> DataFrame:
    """Child rows, or key rows, whose post has been merged."""
    known = posts.select(F.col("PostId").alias("Id"), F.col("Partdate").cast("date").alias("PartDate"))
    return children.join(known, list(CHILD_KEY), "left_semi")


def replace_children(history: DataFrame | None, new: DataFrame, posts: DataFrame) -> DataFrame:
    """History without the rows of the given posts, and the new rows.

    ``posts`` has one row per post key, so the rows are compared to a narrow list.
    """
    if history is None:
        return new
    return union_drift(match_rows(history, posts, POST_KEY, "left_anti"), new)


def merge_children(
    history: DataFrame | None,
    children: DataFrame,
    posts: DataFrame,
    lower: str | date,
    upper: str | date,
    order: Sequence[str] | None = None,
    ties: str = "all",
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Child table after a delta: the newest version's rows of merged posts replace a post's old ones.

    ``posts`` needs the merged posts' ``PostId`` and ``Partdate``, ``history``
    holds the touched days. What decides is settled on narrow key rows (newest
    version per post, then posts that exist), so the wide rows of either side
    are shuffled once. Both sides are matched to these key rows; ``stage`` may
    write them so that they are settled once. ``ties="one"`` keeps a single
    child per post.
    """
    inside = with_day(children).where(in_window("PartDate", lower, upper))
    order = list(order or version_columns(inside))
    names = {"Id": "PostId", "PartDate": "Partdate"}
    if ties == "one":
        new = children_of_posts(latest_per_key(inside, CHILD_KEY, order), posts)
        replaced = new.select(*CHILD_KEY)
    else:
        wanted = stage(children_of_posts(newest_versions(inside, CHILD_KEY, order), posts))
        new = rows_of_versions(inside, wanted, CHILD_KEY, order)
        replaced = wanted.select(*CHILD_KEY)
    return replace_children(history, new.withColumnsRenamed(names), replaced.withColumnsRenamed(names))
