"""Feeds drained with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedfold.operators.latest import latest_per_key
from feedfold.operators.matching import row_salt
from feedfold.operators.merge import coalesce_merge
from feedfold.operators.schema import quoted
from feedfold.session import scratch_path
from feedfold.sources.sinks import replace_partitions, stage
from feedfold.sources.swap import settle
from feedfold.sources.tables import read_partitions

BatchHandler = Callable[[DataFrame, int], None]


def drain(stream: DataFrame, handler: BatchHandler, checkpoint: str, mode: str = "append") -> dict | None:
    """Hand everything not seen yet to the handler, batch by batch, then stop; returns the last batch's progress.

    The checkpoint keeps the position. A batch that failed comes again with
    the same rows and the same id, so handlers must be repeatable.
    """
    query = (
        stream.writeStream.foreachBatch(handler)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query.lastProgress


def drain_to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Append everything not seen yet to a table, each row once."""
    query = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def dedupe_stream(
    stream: DataFrame, keys: Sequence[str], event_time: str, horizon: str = "30 days", salts: int = 8
) -> DataFrame:
    """First message per key; state older than the horizon behind the newest event is let go.

    Copies of one message may be much of a batch, and a stateful operator has
    no partial step. So copies are first dropped per key and salt, in as many
    tasks as there are salts, and what is left of a key meets after that.
    ``salts=1`` leaves the first step out.
    """
    stamped = stream.withColumn("_event_time", quoted(event_time).cast("timestamp"))
    unique = stamped.withWatermark("_event_time", horizon)
    if salts > 1:
        salted = unique.withColumn("_salt", row_salt(unique, salts, keys))
        unique = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return unique.dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")


def newest_stream(stream: DataFrame, keys: Sequence[str], order: Sequence[str], day: str, horizon: str = "30 days") -> DataFrame:
    """Newest message per key and day, by the greatest ``order`` values; a later message replaces an earlier one.

    State is one entry per key and day, let go of once the day is older than the horizon behind the newest. Spark
    combines a batch's copies of a key before they meet their state, so copies of one message cost no more than others. In update mode
    each batch gives the keys whose newest message it has changed, to be laid over what is there (``upsert_handler``); in
    append mode a key is given once, when its day is settled. Rows without a day never settle: set them aside first (``beyond_horizon``).
    """
    rest = [c for c in stream.columns if c not in keys]
    stamped = stream.withColumn("_event_time", quoted(day).cast("timestamp")).withWatermark("_event_time", horizon)
    version = quoted(order[0]) if len(order) == 1 else F.struct(*(quoted(c) for c in order))
    newest = stamped.groupBy(*(quoted(k) for k in keys), F.window("_event_time", "1 day").alias("_settles")).agg(
        F.max_by(F.struct(*(quoted(c) for c in rest)), version).alias("_held")
    )
    return newest.select(*(quoted(k) for k in keys), *(quoted("_held", c).alias(c) for c in rest), "_settles")


def join_streams(
    left: DataFrame, right: DataFrame, key: str, order: Sequence[str], day: str, horizon: str = "1 day", suffix: str = "Metrics"
) -> DataFrame:
    """Full outer join, day by day, of two feeds cut to the newest message per key and day.

    Both feeds are let go of at their watermarks: a day's rows, matched or not, are given once when it is settled on both sides, so
    state holds the days within the horizon only. Key and day are the matched row's or the only side's; other columns of the right
    side that the left has, too, get the suffix.
    """
    sides = []
    for n, side in enumerate((left, right)):
        newest = newest_stream(side, [key], order, day, horizon)
        # what arrives is joined by key and window alone; a copy of the key keeps both sides' names apart
        sides.append(newest.withColumnsRenamed({c: f"_{'lr'[n]}_{c}" for c in newest.columns}))
    a, b = sides
    met = a.join(b, (quoted(f"_l_{key}") == quoted(f"_r_{key}")) & (F.col("_l__settles") == F.col("_r__settles")), "full_outer")
    taken = {c.lower() for c in left.columns}
    both = [F.coalesce(quoted(f"_l_{c}"), quoted(f"_r_{c}")).alias(c) for c in (key, day)]
    own = [quoted(f"_l_{c}").alias(c) for c in left.columns if c not in (key, day)]
    other = [quoted(f"_r_{c}").alias(c + suffix if c.lower() in taken else c) for c in right.columns if c not in (key, day)]
    return met.select(*both, *own, *other)


def upsert_partitions(
    delta: DataFrame,
    path: str,
    partition: str,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] | None = None,
) -> None:
    """Fold a delta into a date-partitioned table, rewriting the delta's days only.

    The newest delta row of each key is laid over the table's row, value by
    value. Doing it again with the same delta changes nothing. A row without a
    day has no partition to go to; callers set such rows aside beforehand.
    """
    settle(delta.sparkSession, path)
    delta = delta.where(quoted(partition).isNotNull())
    newest = latest_per_key(delta, [*keys, partition], order, tiebreak=tiebreak)
    days = sorted(r[0] for r in delta.select(partition).distinct().collect())
    history = read_partitions(delta.sparkSession, path, partition, days)
    if history is None:
        merged = newest
    else:
        merged = coalesce_merge(history, newest, [*keys, partition])
    replace_partitions(merged, path, [partition])


def upsert_handler(
    path: str,
    partition: str,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] | None = None,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    left_out: str | None = None,
) -> BatchHandler:
    """A batch handler that upserts each micro-batch.

    The batch is staged first: its days, its newest rows and the write all
    read the copy, not the source again. Rows without a day have no partition to go to: they are kept in ``left_out``, by default a
    folder of the table that its readers pass over. Their folder is named by batch and content, so that a repeat replaces them
    and other streams do not.
    """
    place = left_out or f"{path}/_left_out"

    copy: list[str] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not copy:
            copy.append(scratch_path(batch.sparkSession, "batch"))
        rows = stage(transform(batch), copy[0])
        undated = rows.where(quoted(partition).isNull())
        count, content = undated.agg(F.count("*"), F.bit_xor(F.xxhash64(F.to_json(F.struct("*"))))).first()
        if count:
            undated.write.mode("overwrite").parquet(f"{place}/batch={batch_id}/content={count}.{content & (1 << 63) - 1:x}")
        if not rows.isEmpty():
            upsert_partitions(rows, path, partition, keys, order, tiebreak)

    return handle


def within_horizon(stream: DataFrame, event_time: str, lower) -> DataFrame:
    """The batch form of the lateness bound: rows of the lower day and later."""
    return stream.where(F.to_date(quoted(event_time)) >= F.lit(lower))


def beyond_horizon(stream: DataFrame, event_time: str, lower) -> DataFrame:
    """The other rows, late and undated ones, with the reason: to be drained to a table of their own and read again from there."""
    day = F.to_date(quoted(event_time))
    reason = F.when(day.isNull(), F.lit("undated")).when(day < F.lit(lower), F.lit("late"))
    return stream.withColumn("_left_out", reason).where(F.col("_left_out").isNotNull())
