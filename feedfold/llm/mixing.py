"""Mixing sources to target weights by Pfair scheduling.

The rows of a source, in the order of a hash, form blocks. All sources flow side by side by their weights, and where one is used up
the others go on by theirs: after flow v, source i has passed min(w_i v, blocks of i), and T(v) is the sum over sources. Block j
(from 1) of a source is released at slot floor(T((j-1)/w)) and due by slot ceil(T(j/w)); each slot goes to the released block that
is due first. The flow itself keeps these bounds, so the slots do, too: no source is ever a whole block ahead of or behind its weight,
however long the table is. Weights are taken as exact fractions, and every source has its own.

Slots depend on one another, so the driver works them out one by one, with a few numbers per source, and writes them to the shared
folder CHUNK at a time: one small row per block, none per row. Only DataFrame expressions touch rows.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from fractions import Fraction
from functools import cmp_to_key
from itertools import accumulate
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedfold.session import scratch_path

BLOCK_ROWS = 16
POWER = 0.5
RANGE_ROWS = 512
CHUNK = 500_000
LEAST = 1e-9


def whole_shares(weights: Mapping[str, float], period: int) -> dict[str, int]:
    """Weights as slots of a period, at least one each, that add up to it (largest remainders first)."""
    total, spare = sum(weights.values()), period - len(weights)
    exact = {k: spare * w / total for k, w in weights.items()}
    out = {k: 1 + int(x) for k, x in exact.items()}
    for k in sorted(exact, key=lambda k: (int(exact[k]) - exact[k], k))[: period - sum(out.values())]:
        out[k] += 1
    return out


def pfair(blocks: Mapping[str, int], weights: Mapping[str, float]) -> Iterator[tuple[str, int]]:
    """(source, block) of slot 0, 1, ...: of the released blocks the one due first, ties by name. Weights are above 0."""
    names = sorted(k for k, n in blocks.items() if n)
    exact = [Fraction(str(weights[k])) for k in names]
    scale = lcm(*(x.denominator for x in exact))
    w, n = [int(x * scale) for x in exact], [blocks[k] for k in names]
    # sources in the order in which the flow uses them up, by n / w; before the e-th end, T(v) = passed[e] + rate[e] * v
    ends = sorted(range(len(names)), key=cmp_to_key(lambda a, b: n[a] * w[b] - n[b] * w[a]))
    passed = list(accumulate((n[i] for i in ends), initial=0))
    rate = list(accumulate((-w[i] for i in ends), initial=sum(w)))
    at = [0] * len(names)  # how many sources have ended where a source's flow is

    def when(i: int, j: int) -> int:
        """T(j / w_i), times w_i."""
        e = at[i]
        if e < len(ends) and j * w[ends[e]] > n[ends[e]] * w[i]:
            e = at[i] = bisect_right(ends, 0, lo=e, key=lambda k: 0 if n[k] * w[i] < j * w[k] else 1)
        return passed[e] * w[i] + rate[e] * j

    done, due = [0] * len(names), [0] * len(names)
    free = [0] * len(names)  # slot of release of the next block
    ready: list[tuple[int, int]] = []
    later: list[tuple[int, int]] = []  # by slot of release

    def release(i: int, slot: int) -> None:
        start, end = free[i], when(i, done[i] + 1)
        due[i], free[i] = -(-end // w[i]), end // w[i]
        if start <= slot:
            heapq.heappush(ready, (due[i], i))
        else:
            heapq.heappush(later, (start, i))

    for i in range(len(names)):
        release(i, 0)
    for slot in range(passed[-1]):
        while later and later[0][0] <= slot:
            i = heapq.heappop(later)[1]
            heapq.heappush(ready, (due[i], i))
        _, i = heapq.heappop(ready)
        yield names[i], done[i]
        done[i] += 1
        if done[i] < n[i]:
            release(i, slot + 1)


def _slots(spark: SparkSession, blocks: Mapping[str, int], weights: Mapping[str, float]) -> DataFrame:
    """_source, _block, _slot of all blocks, in the shared folder."""
    path, kind = scratch_path(spark, "llm-slots"), "_source string, _block long, _slot long"
    names, numbers, first = [], [], 0

    def write() -> None:
        columns = {"_source": pa.array(names, pa.string()), "_block": pa.array(numbers, pa.int64()), "_slot": pa.array(range(first, first + len(names)), pa.int64())}
        spark.createDataFrame(pa.table(columns), kind).write.mode("append").parquet(path)

    for name, block in pfair(blocks, weights):
        names.append(name)
        numbers.append(block)
        if len(names) == CHUNK:
            write()
            first += CHUNK
            names, numbers = [], []
    if names or not first:
        write()
    return spark.read.schema(kind).parquet(path)


def schedule(rows: DataFrame, source: Column, order: Column, weights: Mapping[str, float] | None = None, block_rows: int = BLOCK_ROWS, period: int | None = None) -> DataFrame:
    """rows with _source, _block (in its source), _slot (of the block in the whole) and _place (in the block).

    Without given weights every source weighs its number of rows to the power POWER. Sources that given weights do not name go by
    the name null, as one source, as null sources do; their weight may be given under None, else it is LEAST, as for weights of 0.
    With a period, weights are first rounded to multiples of 1/period by whole_shares().
    """
    if weights is not None and not all(0 <= x < float("inf") for x in weights.values()):
        raise ValueError("weights must be finite and not negative")
    if weights is None:
        name = source
    else:
        given = [k for k in weights if k is not None]
        name = F.when(source.isin(given), source) if given else F.lit(None).cast("string")
    keyed = rows.withColumn("_source", F.coalesce(F.concat(F.lit("="), name), F.lit("")))
    sizes = {r["_source"]: r["count"] for r in keyed.groupBy("_source").count().collect()}  # one row per source
    # a row's rank in its source: its rank in one of many ranges of the hash plus the rows of the ranges before
    bits = min(20, max(4, (sum(sizes.values()) // RANGE_ROWS).bit_length()))
    keyed = keyed.withColumn("_mixed", F.xxhash64(order, F.lit(5))).withColumn("_bucket", F.shiftright(F.col("_mixed"), 64 - bits).cast("int"))
    wanted = {k: float(n) ** POWER if weights is None else float(weights.get(k[1:] if k else None, LEAST)) or LEAST for k, n in sizes.items()}
    if period is not None and wanted:
        wanted = whole_shares(wanted, period)
    slots = _slots(rows.sparkSession, {k: -(-n // block_rows) for k, n in sizes.items()}, wanted)
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = keyed.groupBy("_source", "_bucket").count().withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    # each range takes along the slots of its own few blocks
    first = F.floor(F.col("_before") / block_rows)
    last = F.floor((F.col("_before") + F.col("count") - 1) / block_rows)
    each = ranges.select("_source", "_bucket", "_before", F.explode(F.sequence(first, last)).alias("_block")).join(slots, ["_source", "_block"])
    listed = each.groupBy("_source", "_bucket", "_before").agg(F.sort_array(F.collect_list("_slot")).alias("_slots"))
    within = Window.partitionBy("_source", "_bucket").orderBy("_mixed", order)
    ranked = keyed.withColumn("_rank", F.row_number().over(within) - 1).join(listed, ["_source", "_bucket"])
    rank = F.col("_rank") + F.col("_before")
    placed = ranked.withColumn("_block", F.floor(rank / block_rows)).withColumn("_place", (rank % block_rows).cast("int"))
    slot = F.get("_slots", (F.col("_block") - first).cast("int"))
    return placed.withColumn("_slot", slot).drop("_slots", "_mixed", "_bucket", "_rank", "_before")


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, block_rows: int = BLOCK_ROWS, period: int | None = None) -> DataFrame:
    """doc_id, source, stream (the scheduled source, null for null sources and those that weights leaves out), block, slot, place of every row of docs.

    Rows go by slot, then place. No row is dropped or repeated. Nulls, repeated ids and equal rows are ordinary rows (equal
    ones in either order); an empty table gives no rows.
    """
    rows = docs.select(F.struct("doc_id", "source").alias("held"))
    out = schedule(rows, F.col("held.source"), F.col("held.doc_id"), weights, block_rows, period)
    stream = F.when(F.col("_source") != "", F.substring("_source", 2, 1 << 30))
    return out.select("held.doc_id", "held.source", stream.alias("stream"), F.col("_block").alias("block"), F.col("_slot").alias("slot"), F.col("_place").alias("place"))


def mixed_rows(docs: DataFrame, weights: Mapping[str, float] | None = None, block_rows: int = BLOCK_ROWS, period: int | None = None) -> DataFrame:
    """The rows of docs, with all their columns, sorted into the order of the schedule."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("held"))
    return schedule(rows, F.col("held.source"), F.col("held.doc_id"), weights, block_rows, period).orderBy("_slot", "_place").select("held.*")
