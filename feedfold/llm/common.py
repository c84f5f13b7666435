"""Helpers shared by the training-data operators: staged tables, salted group values, connected components."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedfold.session import scratch_path

SALTS = 64  # those that occur in a group are the bits of a long
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(frame: DataFrame, name: str, packed: str = "snappy") -> DataFrame:
    """The frame written to the shared folder and read back: lineage is cut, lost executors cost nothing.

    Nobody reads the write's shuffle files again; they go as it ends, not when the driver happens to collect its garbage.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.option("compression", packed).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def with_group(rows: DataFrame, key: Sequence[str], spread: Sequence[str], values: Mapping[str, Column], salts: int = SALTS) -> DataFrame:
    """Rows plus values of their group, without gathering a group in one task.

    `values` are aggregates that Spark combines before the shuffle, so a group costs the last step one row per task. They go
    back to the salts (64 at most) that occur, so the list sent back has no more rows than there are, and a group of
    any size is spread over `salts` tasks. Rows with a null in the key are left out.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    whole = salted.groupBy(*key).agg(*(c.alias(n) for n, c in values.items()), F.expr("bit_or(shiftleft(1L, _salt))").alias("_salts"))
    occur = F.expr(f"explode(filter(sequence(0, {salts - 1}), s -> (_salts & shiftleft(1L, s)) <> 0))")
    return salted.join(whole.select(*key, *values, occur.alias("_salt")), [*key, "_salt"]).drop("_salt")


def join_spread(rows: DataFrame, side: DataFrame, key: Sequence[str], spread: Sequence[str], salts: int = SALTS) -> DataFrame:
    """rows inner-joined to side on key; side's rows go to each salt that occurs among the rows of their key."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    there = salted.select(*key, "_salt").distinct()
    return salted.join(side.join(there, [*key]), [*key, "_salt"]).drop("_salt")


def placed(rows: DataFrame, group: str, order: Sequence[Column | str], name: str) -> DataFrame:
    """rows plus `pos`, the place (from 0) of each row in its group, and `n`, the group's rows.

    `order` must tell all rows of a group apart. One range sort deals the rows out, so a group of any size is spread over
    tasks; a row's place is that in its sorted partition plus what the partitions before hold, one small row per group and partition.
    """
    ordered = stage(rows.orderBy(group, *order).withColumn("_at", F.monotonically_increasing_id()), name)
    ordered = ordered.withColumn("_part", F.shiftrightunsigned("_at", 33))
    parts = ordered.groupBy(group, "_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select(group, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("n"))
    return ordered.join(starts, [group, "_part"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _print(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return (row[0], row[1] or 0)


def stars(links: DataFrame, a: str, b: str) -> DataFrame:
    """Edges (u, v), staged, from every linked node u to the smallest node v of its component.

    Large-star and small-star alternate until the edges are a forest of stars; each step is staged. A node
    with very many links is spread over salts, so no step gathers the neighbours of a node.
    """
    pairs = links.where(F.col(a) != F.col(b))
    edges = stage(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = _print(edges)
    while seen[0]:
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
        near = with_group(both, ["u"], ["v"], {"m": F.min("v")})
        large = near.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        low = with_group(large, ["u"], ["v"], {"m": F.min("v")})
        pulled = low.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stage(pulled.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        now = _print(edges)
        if now == seen:
            break
        seen = now
    return edges


def named(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of stars()."""
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every linked node, the component named by its smallest node."""
    return named(stars(links, a, b))
