"""Removal of delta runs that every reader has folded in.

Each merge notes the runs it has folded, with their content, in a ledger. A run goes once all its readers have noted it as it
is now: one that was written again since has another content and stays until it is folded again. Merging a day once more after its runs
have gone finds nothing and changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.sources.files import Store
from feedfold.sources.tables import read_or_empty

CONSUMED_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("run", "content", "consumer")] + [T.StructField("at", T.TimestampType())]
)


def content_of(spark: SparkSession, run: str) -> str | None:
    """What tells one writing of a run's folder from another: its files' names, new with each write, and sizes. None without a folder."""
    store = Store(spark, run)
    if not store.exists(run):
        return None
    files = sorted(f"{f.rpartition('/')[2]}:{size}" for f, size in store.files(run).items())
    return hashlib.md5("\n".join(files).encode()).hexdigest()


def contents(spark: SparkSession, runs: Iterable[str]) -> dict[str, str]:
    """Content of each run folder, to be taken before it is read."""
    return {run: content for run in runs if (content := content_of(spark, run)) is not None}


def note_consumed(spark: SparkSession, ledger: str, consumer: str, seen: dict[str, str]) -> None:
    """Add that a consumer has folded runs in, as they were when read. Doing it again adds nothing that counts."""
    if seen:
        rows = spark.createDataFrame([(run, content, consumer) for run, content in sorted(seen.items())], "run string, content string, consumer string")
        rows.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(ledger)


def folded_by_all(spark: SparkSession, ledger: str, readers: Sequence[str]) -> DataFrame:
    """Runs and contents that all of the readers have noted."""
    noted = read_or_empty(spark, ledger, CONSUMED_SCHEMA).where(F.col("consumer").isin(*readers))
    counted = noted.groupBy("run", "content").agg(F.count_distinct("consumer").alias("readers"))
    return counted.where(F.col("readers") == len(set(readers))).select("run", "content")


def remove_consumed(
    spark: SparkSession, ledger: str, base: str, readers: Sequence[str], archive: str | None = None
) -> list[str]:
    """Remove, or move to an archive, the runs of a delta that all its readers have folded in as they are now; returns them.

    A run that some reader has not noted stays, and so does one that was written again since. The driver goes
    through the noted runs of the delta that still have a folder.
    """
    if not readers:
        raise ValueError("a delta without named readers is never removable")
    store, gone = Store(spark, base), []
    days = {f"{base}/{d}" for d in store.names(base) if d.startswith("exec_date=")}
    left = {f"{day}/{run}" for day in days for run in store.names(day) if run.startswith("exec_time=")}
    for row in folded_by_all(spark, ledger, readers).where(F.col("run").startswith(f"{base}/")).collect():
        run = row["run"]
        if run not in left or content_of(spark, run) != row["content"]:
            continue
        if archive is None:
            store.remove(run)
        else:
            place = f"{archive}{run[len(base):]}"
            store.remove(place)
            store.move(run, place)
        left.remove(run)
        gone.append(run)
    for day in days:
        if not any(run.startswith(f"{day}/") for run in left) and any(run.startswith(f"{day}/") for run in gone):
            store.remove(day)
    return sorted(gone)
