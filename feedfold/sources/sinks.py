"""Writers of delta, partitioned and snapshot tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date
from urllib.parse import quote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from feedfold.functions.dates import as_date
from feedfold.operators.offsets import LEDGER_SCHEMA
from feedfold.operators.schema import align_to, quoted
from feedfold.sources.files import Store
from feedfold.sources.swap import Exchange, leaf_folders, swap
from feedfold.sources.tables import LAYOUT, read_optional


def writer_of(df: DataFrame, fmt: str = "parquet") -> DataFrameWriter:
    """A writer of files. Parquet is packed with zstd: keys are digests in hex, of which it keeps half and snappy all."""
    writer = df.write.format(fmt)
    return writer.option("compression", "zstd") if fmt == "parquet" else writer


def stage(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Write once, read back: what follows scans only the columns it needs.

    The copy lies in the shared folder, so it outlives lost executors, and a
    source whose end moves is read a single time. ``by`` gives each value of a column a folder, so that
    who wants some values reads their files alone; the column comes last then.
    """
    writer = writer_of(df) if by is None else writer_of(df.hint("rebalance", by)).partitionBy(by)
    writer.mode("overwrite").save(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    rebalance: bool = True,
    max_records: int | None = None,
    fmt: str = "parquet",
    owner: str | None = None,
    also: Sequence[str] = (),
) -> None:
    """Replace the partitions that occur in the frame; leave all others alone. Folders of ``also`` go if the frame has no rows for them.

    The new partitions are written whole beside the table, then exchanged folder by folder (see ``swap``): the frame may read the
    table itself, a lost driver leaves no mix, and a second writer is refused.

    Rebalancing lets AQE size the files: small partitions share no task with
    a large one, and a partition holding much of the data is split.
    """
    spark = df.sparkSession
    out = df.hint("rebalance", *columns) if rebalance else df
    writer = writer_of(out, fmt).partitionBy(*columns)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)

    def write(staged: str) -> Exchange:
        writer.save(staged)
        made = leaf_folders(Store(spark, path), staged, columns)
        return Exchange(moves=[(f"{staged}/{f}", f"{path}/{f}") for f in made], removes=[f"{path}/{f}" for f in also if f not in made])

    swap(spark, path, write, owner)


def write_delta(df: DataFrame, base: str, exec_date: str | date, exec_time: str) -> None:
    """One run's rows; running it again replaces them, by none if it has none.

    The run's folder is written as a whole: an overwrite by partitions would leave
    the rows of a run whose repeat is empty. Such a run leaves a file without rows.
    """
    label = quote(exec_time, safe=" ")
    path = f"{base}/exec_date={as_date(exec_date).isoformat()}/exec_time={label}"
    writer_of(df.drop("exec_date", "exec_time")).mode("overwrite").save(path)


def append_ledger(rows: DataFrame, path: str) -> None:
    """Add a run to the ledger; running it again replaces the run's rows."""
    replace_partitions(rows.coalesce(1), path, ["execdate", "exectime"], rebalance=False)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    ledger = read_optional(spark, path)
    return None if ledger is None else align_to(ledger, LEDGER_SCHEMA)


def write_snapshot(
    df: DataFrame,
    base: str,
    snapshot_date: str | date,
    column: str = "snapshot_date",
    keys: Sequence[str] | None = None,
    buckets: int | None = None,
    owner: str | None = None,
) -> None:
    """A day's complete table in its own folder, laid out as the frame is partitioned.

    With ``keys`` and ``buckets`` it is a bucketed table: rows lie by key hash, sorted within each bucket, and a
    record beside them says so, by which ``read_snapshot`` lets joins and windows on the keys do without an exchange. A frame
    that is partitioned the same way is written without one, too, a file per bucket. A day written again is exchanged as a whole.
    """
    folder = f"{column}={as_date(snapshot_date).isoformat()}"
    spark = df.sparkSession

    def write(staged: str) -> Exchange:
        store = Store(spark, base)
        if keys and buckets:
            name = f"feedfold_{uuid.uuid4().hex}"  # a session's catalog alone can write buckets; the entry goes at once
            try:
                writer_of(df).bucketBy(buckets, *keys).sortBy(*keys).option("path", staged).saveAsTable(name)
            finally:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            store.write_new(f"{staged}/{LAYOUT}", {"keys": list(keys), "buckets": buckets, "columns": df._jdf.schema().toDDL()})
        else:
            writer_of(df).save(staged)
        return Exchange(moves=[(staged, f"{base}/{folder}")])

    swap(spark, base, write, owner)


def cluster_by(df: DataFrame, clusters: int, keys: Sequence[str]) -> DataFrame:
    """The given number of partitions by key hash."""
    return df.repartition(clusters, *(quoted(k) for k in keys))


def as_json(df: DataFrame, column: str = "value") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct(*(quoted(c) for c in df.columns)), {"ignoreNullFields": "false"}).alias(column))


def send_json(df: DataFrame, servers: str, topic: str) -> None:
    """Rows as JSON messages of a topic."""
    as_json(df).write.format("kafka").options(**{"kafka.bootstrap.servers": servers, "topic": topic}).save()


def save_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines, where there is no broker."""
    as_json(df).write.mode("overwrite").text(path)
