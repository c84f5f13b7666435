"""Readers of delta, partitioned and snapshot tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.functions.dates import as_date
from feedfold.operators.schema import align_to, union_drift
from feedfold.sources.files import Store

LAYOUT = "_layout"
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_optional(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", **options) -> DataFrame | None:
    """The table, or None where the path is missing or empty. Any other failure is raised."""
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as error:
        if (error.getCondition() or "").startswith(_ABSENT):
            return None
        raise


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """The table in the given schema; no rows where the path is missing or empty."""
    found = read_optional(spark, path, fmt)
    return spark.createDataFrame([], schema) if found is None else align_to(found, schema)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_drifting(
    spark: SparkSession, base: str, folders: Sequence[str], paths: str | Sequence[str], fmt: str = "parquet", files: bool = False
) -> DataFrame | None:
    """Folders, or files, of one table whose types may differ, or None if there are none.

    ``paths`` names them all at once. The reader merges schemas as far as it can. Where types clash, the schema of each folder is read from its
    footers, folders of one schema make one scan, and the scans are widened and united: the plan grows with the
    schemas that occur, not with the folders. A folder that is missing is passed over. ``files`` adds each row's file as ``_file``.
    """
    options = {"basePath": base, "mergeSchema": "true"}
    named = lambda df: df.select("*", F.col("_metadata.file_path").alias("_file")) if files else df
    try:
        found = read_optional(spark, paths, fmt, **options)
        return None if found is None else named(found)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMA" not in str(error):
            raise
    alike: dict[str, tuple[T.StructType, list[str]]] = {}
    # footers are read folder by folder, a few at a time
    with ThreadPoolExecutor(min(8, max(len(folders), 1))) as pool:
        read = inheritable_thread_target(spark)(lambda folder: read_optional(spark, folder, fmt, **options))
        for folder, found in zip(folders, pool.map(read, folders)):
            if found is not None:
                alike.setdefault(found.schema.json(), (found.schema, []))[1].append(folder)
    scans = [
        named(spark.read.format(fmt).option("basePath", base).schema(schema).load(same)) for schema, same in alike.values()
    ]
    return union_drift(*scans) if scans else None


def delta_runs(spark: SparkSession, base: str, exec_date: str | date) -> list[str]:
    """Folders of a day's runs."""
    day = f"{base}/exec_date={as_date(exec_date).isoformat()}"
    return [f"{day}/{n}" for n in _folders(spark, day, "exec_time")]


def read_delta(
    spark: SparkSession, base: str, exec_date: str | date, fmt: str = "parquet", runs: Sequence[str] | None = None
) -> DataFrame | None:
    """All runs of one day, or None if there were none.

    Only that day's folder is listed. Runs whose columns or types differ are aligned. ``runs`` names folders that
    ``delta_runs`` has found, so that a run arriving since is not read.
    """
    runs = delta_runs(spark, base, exec_date) if runs is None else list(runs)
    return read_drifting(spark, base, runs, runs, fmt) if runs else None


def read_partitions(
    spark: SparkSession, base: str, column: str, values: Sequence[date], fmt: str = "parquet", files: bool = False
) -> DataFrame | None:
    """The named partitions of a table, or None if it has none of them.

    The days go into the path, so the files of other partitions are not even
    listed, and a day the table lacks is passed over. Schemas are merged over
    these partitions only: an old or foreign column is not lost, and a field
    whose type differs from day to day is widened. ``files`` adds each row's file as ``_file``.
    """
    if not values:
        return None
    days = sorted({v.isoformat() for v in values})
    folders = [f"{base}/{column}={d}" for d in days]
    return read_drifting(spark, base, folders, f"{base}/{column}={{{','.join(days)}}}", fmt, files)


def _folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Names of the partition folders below a path, one level deep."""
    return [n for n in Store(spark, path).names(path) if n.startswith(f"{column}=")]


def layout_of(spark: SparkSession, folder: str) -> dict | None:
    """Keys, buckets and columns of a folder written as a bucketed table, or None."""
    return Store(spark, folder).read(f"{folder}/{LAYOUT}")


def read_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """A table folder, as the buckets it was written in where its layout record tells them."""
    layout = layout_of(spark, folder)
    if layout is None:
        return spark.read.parquet(folder)
    keys = ", ".join(_name(k) for k in layout["keys"])
    name = f"feedfold_{uuid.uuid4().hex}"
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    buckets = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {layout['buckets']} BUCKETS"
    spark.sql(f"CREATE TABLE {name} ({layout['columns']}) USING parquet {buckets} LOCATION '{place}'")
    try:  # the frame knows files and buckets from here on; the catalog need not keep them
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def latest_snapshot_folder(spark: SparkSession, base: str, before: str | date, column: str = "snapshot_date") -> str | None:
    """Folder of the newest snapshot older than a day, or None. Names tell; no other snapshot's files are listed."""
    days = [as_date(n.partition("=")[2]) for n in _folders(spark, base, column)]
    older = [d for d in days if d < as_date(before)]
    return f"{base}/{column}={max(older).isoformat()}" if older else None


def latest_snapshot(
    spark: SparkSession, base: str, before: str | date, column: str = "snapshot_date"
) -> DataFrame | None:
    """The newest snapshot older than a day, or None."""
    folder = latest_snapshot_folder(spark, base, before, column)
    return None if folder is None else read_snapshot(spark, folder)
