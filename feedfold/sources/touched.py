"""Upserts that rewrite only the files holding rows that change.

A day of a large table has many files, and a delta's keys lie in some of them. Which ones is found by a semi join over the key columns
and each row's file name. Those files are read, merged with the delta and written anew; all others of the day stay as they are.
The exchange of old files for new ones survives a lost driver (see ``swap``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.operators.latest import latest_per_key
from feedfold.operators.matching import match_rows
from feedfold.operators.merge import coalesce_merge
from feedfold.operators.schema import find_field, quoted, same_type
from feedfold.sources.files import Store
from feedfold.sources.sinks import writer_of
from feedfold.sources.swap import Exchange, leaf_folders, settle, swap
from feedfold.sources.tables import read_drifting, read_partitions

SMALL_BYTES = 8 << 20
SLOT = "_slot"


@dataclass(frozen=True)
class FileReport:
    """Files of the touched days that were rewritten and that were left alone."""

    rewritten: list[str]
    kept: list[str]


def touched_files(history: DataFrame, changed: DataFrame, keys: Sequence[str]) -> list[str]:
    """Files (column ``_file``) of the history rows whose key occurs in ``changed``, which has each key once.

    The driver gets names, of at most the files of the days at hand.
    """
    hit = match_rows(history.select(*(quoted(k) for k in keys), "_file"), changed, keys, "left_semi")
    return sorted(r["_file"] for r in hit.select("_file").distinct().collect())


def rewrite_touched(
    spark: SparkSession,
    path: str,
    partition: str,
    days: Sequence[date],
    keys: Sequence[str],
    changed: DataFrame,
    merge: Callable[[DataFrame | None], DataFrame],
    fmt: str = "parquet",
    spread: int = 1,
    small_bytes: int = SMALL_BYTES,
    owner: str | None = None,
) -> FileReport:
    """Replace the files that hold keys of ``changed`` by what ``merge`` makes of their rows.

    ``merge`` gets the rows of those files, or None, and returns them with the delta laid over; ``keys`` include the partition column.
    Files under ``small_bytes`` are taken along, so that added rows do not pile up in small files. Where the merge changes
    the type of a column all files of the days are rewritten, since the files of one folder must agree. ``spread`` deals
    a day's rows to that many files at least by key hash, so that few keys lie in few files.
    """
    settle(spark, path, owner)
    store = Store(spark, path)
    there = {f: size for d in days for f, size in store.files(f"{path}/{partition}={d.isoformat()}").items()}
    history = read_partitions(spark, path, partition, days, fmt, files=True)
    take: set[str] = set()
    if history is not None:
        own = history.drop("_file")
        made = merge(own).schema
        fits = lambda f: (g := find_field(made, f.name)) is not None and same_type(f.dataType, g.dataType)
        if all(fits(f) for f in own.schema.fields):
            take = {store.path_of(f) for f in touched_files(history, changed, keys)}
            take |= {f for f, size in there.items() if size < small_bytes}
        else:
            take = set(there)
    files = sorted(take)
    out = merge(read_drifting(spark, path, files, files, fmt) if files else None)
    columns = [partition]
    if spread > 1:
        out = out.withColumn(SLOT, F.pmod(F.xxhash64(*(quoted(k) for k in keys)), F.lit(spread)).cast("int"))
        columns.append(SLOT)

    def write(staged: str) -> Exchange:
        writer_of(out.hint("rebalance", *columns), fmt).partitionBy(*columns).save(staged)
        places = {}
        for folder in leaf_folders(store, staged, columns):
            day, _, slot = folder.partition("/")
            for f in store.files(f"{staged}/{folder}"):
                name = f.rpartition("/")[2]  # alike in the folders of a day's slots, whose files come together here
                places[f] = f"{path}/{day}/{slot.replace(f'{SLOT}=', 's') + '-' if slot else ''}{name}"
        return Exchange(removes=files, moves=list(places.items()))

    swap(spark, path, write, owner)
    return FileReport(files, sorted(set(there) - take))


def upsert_touched(
    delta: DataFrame,
    path: str,
    partition: str,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] | None = None,
    spread: int = 1,
    small_bytes: int = SMALL_BYTES,
    owner: str | None = None,
) -> FileReport:
    """The newest delta row of each key laid over the table's row, value by value, rewriting only files that hold such keys.

    The delta is read several times and so best staged. A row without a day has no place; callers set such rows aside beforehand.
    """
    full = [*keys, partition]
    newest = latest_per_key(delta.where(quoted(partition).isNotNull()), full, order, tiebreak=tiebreak)
    days = sorted(r[0] for r in delta.select(quoted(partition)).distinct().collect() if r[0] is not None)
    lay = lambda old: newest if old is None else coalesce_merge(old, newest, full)
    return rewrite_touched(delta.sparkSession, path, partition, days, full, newest, lay, spread=spread, small_bytes=small_bytes, owner=owner)
