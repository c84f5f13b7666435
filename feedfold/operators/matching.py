"""Semi and anti joins of skewed rows against a list of keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.operators.schema import quoted


def row_salt(df: DataFrame, salts: int, keys: Sequence[str] = ()) -> Column:
    """A number below ``salts`` that spreads the rows of any one key.

    The task's partition spreads rows that lie across a table, copies of one
    row included; a hash of two narrow columns spreads those that an earlier
    shuffle has brought together. Wide columns are left alone, so that a scan
    need not read them for this. A retried task computes the same salts.
    """
    taken = {k.lower() for k in keys}
    narrow = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.NumericType, T.DatetimeType)) and f.name.lower() not in taken
    ]
    content = F.xxhash64(*(quoted(c) for c in narrow[:2])) if narrow else F.lit(0)
    return F.pmod(content + F.spark_partition_id(), F.lit(salts)).cast("int")


def match_rows(
    rows: DataFrame, keys: DataFrame, on: Sequence[str], how: str, salts: int = 1
) -> DataFrame:
    """``left_semi`` or ``left_anti`` of rows against keys, where nulls match nulls.

    A key list has one narrow row per key. Each side has an exchange of its
    own, and where the rows of a hot key make a partition large, AQE splits the
    row side and repeats that partition's keys only. With ``salts`` the rows of
    every key go to that many tasks whatever their number, at the price of a
    key list repeated as often: for rows that lie under few keys.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"rows can be kept or dropped by key, not joined with {how!r}")
    names = [f"_k{i}" for i in range(len(on))]
    wanted = keys.select(*(quoted(c).alias(n) for c, n in zip(on, names)))
    same = [quoted(c).eqNullSafe(F.col(n)) for c, n in zip(on, names)]
    if salts == 1:
        return rows.join(wanted, reduce(Column.__and__, same), how)
    wanted = wanted.withColumn("_ks", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_salt", row_salt(rows, salts, on))
    same.append(F.col("_salt") == F.col("_ks"))
    return salted.join(wanted, reduce(Column.__and__, same), how).drop("_salt")
