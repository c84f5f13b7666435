"""The ledger of how far each feed partition has been read."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.operators.schema import quoted

EARLIEST = -2

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("kafkapartition", T.IntegerType()),
        T.StructField("latestoffset", T.LongType()),
        T.StructField("topic", T.StringType()),
        T.StructField("consumergroup", T.StringType()),
        T.StructField("execdate", T.StringType()),
        T.StructField("exectime", T.StringType()),
    ]
)


def run_offsets(
    messages: DataFrame,
    topic: str,
    group: str,
    exec_date: str,
    exec_time: str,
    partition_column: str = "kafkapartition",
    offset_column: str = "kafkaoffset",
) -> DataFrame:
    """Greatest offset of each partition in this run, as ledger rows."""
    return messages.groupBy(quoted(partition_column).cast("int").alias("kafkapartition")).agg(
        F.max(quoted(offset_column)).alias("latestoffset")
    ).withColumns(
        {
            "topic": F.lit(topic),
            "consumergroup": F.lit(group),
            "execdate": F.lit(exec_date),
            "exectime": F.lit(exec_time),
        }
    )


def next_offsets(ledger: DataFrame) -> DataFrame:
    """Where each partition goes on: one past the offset of its own latest run.

    A partition idle in the last run keeps the offset of an earlier one. Runs of a day are told
    apart by their offsets: labels of clock times and of batches do not sort together.
    """
    run = F.struct("execdate", "latestoffset")
    return ledger.groupBy("topic", "kafkapartition").agg(
        (F.max_by("latestoffset", run) + 1).alias("nextoffset")
    )


def starting_offsets(
    offsets: Mapping[int, int], topic: str, partitions: Iterable[int] | None = None
) -> str:
    """Start positions of a feed as JSON; partitions without one start at the earliest message."""
    wanted = sorted(set(offsets) | set(partitions or ()))
    if not wanted:
        raise ValueError(f"no offsets for {topic}")
    if any(o < 0 for o in offsets.values()):
        raise ValueError(f"bad offsets for {topic}: {dict(offsets)}")
    return json.dumps({topic: {str(p): int(offsets.get(p, EARLIEST)) for p in wanted}})
