"""Exact duplicates by deterministic block naming.

A text is cut into blocks of fixed size. Distinct blocks are sorted by (fingerprint, content) and named by
integers: the fingerprint and the block's rank among those that share it, so that two blocks have one name
exactly if they are equal. Then adjacent pairs of names are named the same way, level by level, until each
text has one name; with the text's length it identifies the text without any chance of a collision.

Only DataFrame expressions run here. Each level moves its distinct pieces once; groups of copies are spread over
salts, so a group of any size is handled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedfold.llm.common import stage, with_group

WHITE = " \t\n\x0b\x0c\r"
BLOCK_BYTES = 4096


def normalised(text: Column) -> Column:
    """The text without any of space, tab, line feed, vertical tab, form feed and carriage return; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def _fingerprint(piece: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(piece), 64 - bits) if bits < 64 else F.xxhash64(piece)


def _named(rows: DataFrame, pieces: str, bits: int, name: str) -> DataFrame:
    """rows, staged, with the array of pieces replaced by `names`, an array of collision-free (fingerprint, rank)."""
    others = [c for c in rows.columns if c != pieces]
    listed = rows.select(F.explode(pieces).alias("piece")).select(_fingerprint(F.col("piece"), bits).alias("h"), "piece").distinct()
    shared = stage(listed.groupBy("h").count().where("count > 1").select("h"), f"{name}-clashes")
    if shared.isEmpty():
        clear = F.transform(pieces, lambda p: F.struct(_fingerprint(p, bits).alias("h"), F.lit(0).alias("rank")))
        return stage(rows.select(*others, clear.alias("names")), name)
    order = Window.partitionBy("h").orderBy("piece")
    ranks = stage(listed.join(shared, "h", "left_semi").withColumn("rank", F.row_number().over(order) - 1).where("rank > 0"), f"{name}-ranks")
    each = rows.withColumn("_at", F.monotonically_increasing_id()).select("*", F.posexplode(pieces).alias("pos", "piece")).drop(pieces)
    found = each.withColumn("h", _fingerprint(F.col("piece"), bits)).join(ranks, ["h", "piece"], "left")
    back = found.groupBy("_at").agg(
        *(F.first(c).alias(c) for c in others),
        F.sort_array(F.collect_list(F.struct("pos", "h", F.coalesce("rank", F.lit(0)).alias("rank")))).alias("all"),
    )
    return stage(back.select(*others, F.transform("all", lambda x: F.struct(x["h"], x["rank"])).alias("names")), name)


def _pairs(names: str) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(names) / 2).cast("int") - 1),
        lambda i: F.struct(F.get(names, i * 2).alias("left"), F.get(names, i * 2 + 1).alias("right")),
    )


def name_texts(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bits: int = 64) -> DataFrame:
    """One row per row of docs: row, doc_id, chars, bytes, text_sha256 and identity, the text's collision-free name.

    bits narrows the fingerprint, which only tests need: names stay free of collisions at any width.
    """
    body = docs.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"), F.encode(normalised(F.col("text")), "UTF-8").alias("body"))
    steps = F.sequence(F.lit(0), F.greatest(F.ceil(F.length("body") / block_bytes).cast("int") - 1, F.lit(0)))
    cut = body.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "chars",
        F.length("body").cast("long").alias("bytes"),
        F.sha2("body", 256).alias("text_sha256"),
        F.transform(steps, lambda i: F.substring(F.col("body"), i * block_bytes + 1, F.lit(block_bytes))).alias("pieces"),
    )
    named = _named(cut, "pieces", bits, "blocks")
    longest = named.agg(F.max(F.size("names"))).first()[0] or 1
    while longest > 1:
        paired = named.where(F.size("names") > 1).withColumn("pieces", _pairs("names")).drop("names")
        named = named.where(F.size("names") == 1).unionByName(_named(paired, "pieces", bits, "pairs"))
        longest = (longest + 1) // 2
    top = F.get("names", F.lit(0))
    return named.select("row", "doc_id", "chars", "bytes", "text_sha256", F.struct("bytes", top["h"].alias("h"), top["rank"].alias("rank")).alias("identity"))


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bits: int = 64) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, chars.

    Texts are equal if they are so without white space; a null text is empty, and all empty texts are one group.
    Of a group the row with the most code points stays, then that of the smallest doc_id (null last), then the first
    of rows that repeat one another. Columns besides doc_id and text are not read; an empty table gives no rows.
    """
    named = name_texts(docs, block_bytes, bits)
    best = F.struct((-F.col("chars")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    grouped = with_group(named, ["identity"], ["row"], {"best": F.min(best), "n": F.count("*")})
    return grouped.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
        "chars",
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_duplicates() keeps, with all their columns."""
    held = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("held"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
        F.col("doc_id").isNull().alias("unnamed"),
        F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256).alias("sha"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"),
    )
    key = ["id", "unnamed", "sha", "chars"]
    keep = exact_duplicates(docs).where("kept").select(
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col("doc_id").isNull().alias("unnamed"), F.col("text_sha256").alias("sha"), "chars"
    )
    return held.join(keep, key, "left_semi").dropDuplicates(key).select("held.*")


ORACLE = """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY chars DESC, doc_id) = 1 AS kept,
       sha256(body) AS text_sha256
FROM t"""
