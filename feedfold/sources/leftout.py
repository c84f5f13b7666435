"""Rows that a merge's day window leaves out: kept with the reason, and read again once a window or a given day admits them.

They lie as the delta's runs do, a folder per run, in that run's own columns. Whatever a merge reads it either folds in or keeps here.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.operators.merge import in_window, left_out_reason
from feedfold.operators.schema import find_field, quoted
from feedfold.sources import sinks, tables
from feedfold.sources.files import Store
from feedfold.sources.swap import Exchange, leaf_folders, settle, swap

REASON = "_left_out"
RUN = ("exec_date", "exec_time")


def _inside(column: str, lower: str | date, upper: str | date) -> Column:
    return F.coalesce(in_window(column, lower, upper), F.lit(False))


def keep_left_out(rows: DataFrame, base: str, lower: str | date, upper: str | date, column: str = "PartDate") -> None:
    """Keep the rows outside a window, undated ones included, with their reason. Rows carry their run's ``exec_date`` and ``exec_time``.

    Doing it again for the same runs replaces theirs.
    """
    marked = rows.withColumn(REASON, left_out_reason(column, lower, upper)).where(F.col(REASON).isNotNull())
    sinks.replace_partitions(marked, base, RUN)


def read_left_out(spark: SparkSession, base: str) -> DataFrame | None:
    """All rows kept, with ``_left_out`` and the run they came in; None if there are none."""
    runs = [f"{base}/{f}" for f in leaf_folders(Store(spark, base), base, RUN)]
    return tables.read_drifting(spark, base, runs, runs) if runs else None


def dated(rows: DataFrame, days: DataFrame, keys: Sequence[str], column: str = "PartDate") -> DataFrame:
    """Rows whose undated ones get the day that ``days`` (a key once) gives for their key."""
    given = days.select(*(quoted(k).alias(f"_g{i}") for i, k in enumerate(keys)), quoted(column).cast("date").alias("_given"))
    same = reduce(Column.__and__, [quoted(k) == F.col(f"_g{i}") for i, k in enumerate(keys)])
    own = find_field(rows.schema, column).name
    columns = [F.coalesce(quoted(c), "_given").alias(c) if c == own else quoted(c) for c in rows.columns]
    return rows.join(given, same, "left").select(*columns)


class Held:
    """The rows kept at a place, as a window finds them."""

    def __init__(self, spark: SparkSession, base: str, lower: str | date, upper: str | date, column: str = "PartDate", days: DataFrame | None = None, keys: Sequence[str] = ("Id",)):
        settle(spark, base)
        self._spark, self._base, self._column, self._window = spark, base, column, (lower, upper)
        rows = read_left_out(spark, base)
        self._rows = rows if rows is None or days is None else dated(rows, days, keys, column)

    def admitted(self) -> DataFrame | None:
        """Rows inside the window, with the run they came in; None if nothing is kept at all."""
        return None if self._rows is None else self._rows.where(_inside(self._column, *self._window)).drop(REASON)

    def release(self) -> None:
        """Keep only the others: called once the admitted rows are in their table.

        Runs that lost rows are written anew, or removed, in one exchange. A driver lost before it finds the rows admitted once more
        by the run's repeat, which merges them to the same result.
        """
        if self._rows is None:
            return
        inside = _inside(self._column, *self._window)
        runs = {(str(r[0]), r[1]) for r in self._rows.where(inside).select(*RUN).distinct().collect()}
        if not runs:
            return
        store = Store(self._spark, self._base)
        label = lambda folder: tuple(unquote(part.partition("=")[2]) for part in folder.split("/"))
        losing = {f for f in leaf_folders(store, self._base, RUN) if label(f) in runs}
        run = F.struct(F.col("exec_date").cast("string").alias("d"), F.col("exec_time").cast("string").alias("t"))
        wanted = F.array(*(F.struct(F.lit(d).alias("d"), F.lit(t).alias("t")) for d, t in sorted(runs)))
        staying = self._rows.where(~inside & F.array_contains(wanted, run))

        def write(staged: str) -> Exchange:
            sinks.writer_of(staying).partitionBy(*RUN).save(staged)
            made = leaf_folders(store, staged, RUN)
            kept = {label(f): f for f in made}
            moves = [(f"{staged}/{kept[label(f)]}", f"{self._base}/{f}") for f in losing if label(f) in kept]
            return Exchange(moves=moves, removes=[f"{self._base}/{f}" for f in losing if label(f) not in kept])

        swap(self._spark, self._base, write)
