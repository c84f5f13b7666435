"""Message feeds.

The Kafka connector is a package of its own; everything behind the reader
works on an envelope frame ``value, partition, offset``, wherever that comes
from.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.operators.offsets import next_offsets, starting_offsets


@dataclass(frozen=True)
class Feed:
    servers: str
    topic: str
    group: str


def feed_options(feed: Feed, starting: str = "earliest", batch: bool = True) -> dict[str, str]:
    """Reader options; a batch reads up to the latest message, lost messages are no error."""
    options = {
        "kafka.bootstrap.servers": feed.servers,
        "kafka.group.id": feed.group,
        "subscribe": feed.topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if batch:
        options["endingOffsets"] = "latest"
    return options


def read_feed(spark: SparkSession, feed: Feed, starting: str = "earliest") -> DataFrame:
    return spark.read.format("kafka").options(**feed_options(feed, starting)).load()


def stream_feed(spark: SparkSession, feed: Feed, starting: str = "earliest") -> DataFrame:
    """Streaming twin; after the first run the checkpoint decides where to start."""
    return spark.readStream.format("kafka").options(**feed_options(feed, starting, batch=False)).load()


def feed_start(
    ledger: DataFrame | None, feed: Feed, partitions: Iterable[int] | None = None
) -> tuple[str, bool]:
    """Where to start reading, and whether this is the feed's first run.

    First run means a ledger without rows for the topic and group. Only one
    row per feed partition comes to the driver.
    """
    if ledger is None:
        return "earliest", True
    own = ledger.where((F.col("topic") == feed.topic) & (F.col("consumergroup") == feed.group))
    offsets = {r["kafkapartition"]: r["nextoffset"] for r in next_offsets(own).collect()}
    if not offsets:
        return "earliest", True
    return starting_offsets(offsets, feed.topic, partitions), False


def resume_feed(
    spark: SparkSession, feed: Feed, ledger: DataFrame | None, partitions: Iterable[int] | None = None
) -> tuple[DataFrame, bool]:
    """The unread part of a feed, and whether this is its first run."""
    starting, first = feed_start(ledger, feed, partitions)
    return read_feed(spark, feed, starting), first


def file_feed(
    spark: SparkSession,
    path: str,
    schema,
    fmt: str = "parquet",
    max_files: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """A stream of the files arriving under a path.

    ``clean_source`` (``delete`` or ``archive``) removes files once a later
    batch has committed them.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.load(path)
