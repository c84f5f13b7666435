"""Rows in which every leaf is its type's default."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default of a leaf.
DEFAULTS = {
    T.StringType: "",
    T.IntegerType: 0,
    T.LongType: 0,
    T.DoubleType: 0.0,
    T.FloatType: 0.0,
    T.BooleanType: False,
}


def default_value(dtype: T.DataType) -> Column:
    """Default of a type: zero, empty, the epoch; one default element in an array; else null."""
    if isinstance(dtype, T.StructType):
        return F.struct(*(default_value(f.dataType).alias(f.name) for f in dtype.fields))
    if isinstance(dtype, T.ArrayType):
        return F.array(default_value(dtype.elementType))
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_seconds(F.lit(0))
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(datetime(1970, 1, 1)).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.lit(date(1970, 1, 1))
    return F.lit(DEFAULTS.get(type(dtype))).cast(dtype)


def default_columns(schema: T.StructType) -> list[Column]:
    return [default_value(f.dataType).alias(f.name) for f in schema.fields]


def default_rows(spark: SparkSession, schema: T.StructType, n: int) -> DataFrame:
    """``n`` default rows."""
    return spark.range(n).select(*default_columns(schema))
