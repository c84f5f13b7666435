"""Newest rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.operators.matching import match_rows
from feedfold.operators.schema import quoted


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: str = "one",
    tiebreak: Sequence[str] | None = None,
    salts: int = 1,
) -> DataFrame:
    """Rows with the greatest ``order`` values of their key, nulls last.

    ``ties="one"`` keeps one row. Equal ones are told apart by ``tiebreak``,
    by default all other columns, so rows that still tie are the same row.
    Every task cuts its input down to one row per key before the shuffle, so
    a key holding much of the data costs no more than any other.

    ``ties="all"`` keeps all rows of the newest version. That may be most of
    the data under one key, so the rows are never gathered by key: the newest
    version of each key is aggregated first, then matched to the rows.
    """
    if ties == "all":
        newest = newest_versions(df, keys, order)
        return rows_of_versions(df, newest, keys, order, salts)
    if ties != "one":
        raise ValueError(f"unknown ties {ties!r}")
    if tiebreak is None:
        used = {c.lower() for c in (*keys, *order)}
        tiebreak = [f.name for f in df.schema.fields if f.name.lower() not in used and _orderable(f.dataType)]
    window = Window.partitionBy(*(quoted(k) for k in keys)).orderBy(
        *(quoted(c).desc_nulls_last() for c in ([*order, *tiebreak] or keys))
    )
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def newest_versions(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The greatest ``order`` values of each key, as one narrow row: keys and ``_newest``."""
    return df.groupBy(*(quoted(k) for k in keys)).agg(F.max(_version(order)).alias("_newest"))


def rows_of_versions(
    df: DataFrame, versions: DataFrame, keys: Sequence[str], order: Sequence[str], salts: int = 1
) -> DataFrame:
    """The rows belonging to the given key versions."""
    tagged = df.withColumn("_newest", _version(order))
    return match_rows(tagged, versions, [*keys, "_newest"], "left_semi", salts).drop("_newest")


def _version(order: Sequence[str]) -> Column:
    """One comparable value; a single column stays plain so that max() hashes."""
    return quoted(order[0]) if len(order) == 1 else F.struct(*(quoted(c) for c in order))
