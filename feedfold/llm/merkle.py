"""Merkle manifest of a table of documents: leaves, roots and proofs by slot pivots.

Consecutive nodes are gathered `width` = fanout ** levels at a time: conditional aggregates spread them into one column
per slot. Concatenating the columns of a run hashes it, level above level, and the columns of a run without
the own slot's are a node's siblings. So each pivot climbs several levels of the tree, over a width-th of the rows of the last one, and
proofs come down the same way: a block's path to the root goes once to each node in it.

Every document set of one language is a tree; their roots, in order, are the leaves of the tree above. Trees of any size are spread
by (tree, block), so a language with most of the rows is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import placed, stage

FANOUT, LEVELS = 2, 4
TAMPER = 7


def _part(value: Column) -> Column:
    """One input of a leaf: `-` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*(_part(c) for c in (doc_id, source, lang, n_chars, text))), 256)


def leaves(docs: DataFrame, tamper: int = TAMPER) -> DataFrame:
    """row, doc_id, tree, leaf and bad (the leaf after tampering, null where nothing is tampered with) of every row of docs.

    Tampering adds 1 to n_chars where tamper divides the CRC-32 of the decimal doc_id; rows without doc_id or n_chars stay as they are.
    `tree` names the language so that names sort as languages do, null first.
    """
    c = {n: F.col(f"`{n}`") for n in ("doc_id", "source", "lang", "n_chars", "text")}
    more = c["n_chars"].cast("decimal(38,0)") + 1
    hit = (F.crc32(c["doc_id"].cast("string")) % tamper == 0) & c["n_chars"].isNotNull()
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        c["doc_id"].alias("doc_id"),
        F.when(c["lang"].isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), c["lang"])).alias("tree"),
        leaf_hash(**c).alias("leaf"),
        F.when(hit, leaf_hash(**(c | {"n_chars": more}))).alias("bad"),
    )


def _deep(n: Column, fanout: int, levels: int) -> Column:
    """Levels a block of a tree with n nodes has: all of them, or in the topmost block what it takes to get to one node."""
    out = F.lit(levels)
    for t in reversed(range(levels)):
        out = F.when(n <= fanout**t, t).otherwise(out)
    return out


def pivoted(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """tree, block, n, deep, slots (one array of hashes per level, absent nodes null) and hash of every block of nodes (tree, pos, n, hash)."""
    width = fanout**levels
    slot = F.col("pos") % width
    blocks = nodes.groupBy("tree", F.floor(F.col("pos") / width).alias("block")).agg(
        F.max("n").alias("n"), *(F.max(F.when(slot == i, F.col("hash"))).alias(f"l0_{i}") for i in range(width))
    )
    for t in range(1, levels + 1):
        runs = {}
        for i in range(width // fanout**t):
            run = [F.col(f"l{t - 1}_{j}") for j in range(i * fanout, (i + 1) * fanout)]
            runs[f"l{t}_{i}"] = F.when(run[0].isNotNull(), F.sha2(F.concat_ws("", *run), 256))
        blocks = blocks.withColumns(runs)
    blocks = blocks.withColumn("deep", _deep(F.col("n"), fanout, levels))
    top = F.coalesce(*(F.when(F.col("deep") == t, F.col(f"l{t}_0")) for t in range(levels + 1)))
    each = [F.array(*(F.col(f"l{t}_{i}") for i in range(width // fanout**t))) for t in range(levels)]
    return blocks.select("tree", "block", "n", "deep", F.array(*each).alias("slots"), top.alias("hash"))


def _siblings(slot: Column, slots: Column, deep: Column, fanout: int, levels: int) -> Column:
    """Of the node at a slot, level by level: what stands left and right of it in its run."""
    out = []
    for t in range(levels):
        own = F.floor(slot / fanout**t).cast("int")
        at = own % fanout
        left = F.array_join(F.slice(slots[t], own - at + 1, at), "")
        right = F.array_join(F.slice(slots[t], own + 2, fanout - 1 - at), "")
        out.append(F.struct(left.alias("left"), right.alias("right")))
    return F.slice(F.array(*out), 1, deep)


def climb(nodes: DataFrame, fanout: int, levels: int, name: str) -> list[DataFrame]:
    """The staged blocks of each pivot, the last with one block per tree, whose hash is the tree's root."""
    out, width = [], fanout**levels
    while True:
        out.append(stage(pivoted(nodes, fanout, levels), f"{name}-{len(out)}"))
        most = out[-1].agg(F.max("n")).first()[0] or 0
        if most <= width:
            return out
        nodes = out[-1].select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / width).alias("n"), "hash")


def descend(nodes: DataFrame, blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """nodes (tree, pos, more) with what their block knows of the top (subroot, root) and path, the siblings from the node up to the root."""
    width = fanout**levels
    held = blocks.select("tree", "block", "slots", "deep", "subroot", "root", F.col("path").alias("_up"))
    met = nodes.withColumn("block", F.floor(F.col("pos") / width)).join(held, ["tree", "block"])
    own = _siblings((F.col("pos") % width).cast("int"), F.col("slots"), F.col("deep"), fanout, levels)
    return met.withColumn("path", F.concat(own, "_up")).drop("block", "slots", "deep", "_up")


def _paths(pivots: list[DataFrame], top: DataFrame, fanout: int, levels: int, name: str) -> DataFrame:
    """The lowest blocks with subroot, root and path: the siblings from the block up to the root. top: these of each tree's root."""
    known = pivots[-1].join(top, "tree")
    for k, blocks in reversed(list(enumerate(pivots[:-1]))):
        below = blocks.withColumnRenamed("block", "pos").select("tree", "pos", "n", F.struct("slots", "deep").alias("own"))
        found = descend(below, known, fanout, levels)
        known = stage(found.select("tree", F.col("pos").alias("block"), "own.slots", "own.deep", "subroot", "root", "path"), f"{name}-{k}")
    return known


def manifest(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS, tamper: int = TAMPER) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of docs.

    Leaves of a language stand in the order of doc_id, null first; rows that repeat a doc_id in that of their leaves, and rows equal in all
    as read. Every row is a leaf of its own. Texts of any length are hashed whole. A tree of one leaf has that as its root, and the proof of
    an only row of an only language is the hash of nothing. Other columns are not read; an empty table gives no rows.
    """
    rows = stage(leaves(docs, tamper), "leaves")
    rows = placed(rows, "tree", ["doc_id", "leaf", "row"], "order")
    pivots = climb(rows.select("tree", "pos", "n", F.col("leaf").alias("hash")), fanout, levels, "pivot")
    subroots = pivots[-1].select(F.lit("").alias("all"), F.col("tree").alias("name"), F.col("hash").alias("subroot"))
    above = placed(subroots, "all", ["name"], "subroots").select(F.col("all").alias("tree"), "pos", "n", "name", "subroot")
    tops = climb(above.select("tree", "pos", "n", F.col("subroot").alias("hash")), fanout, levels, "top")
    root = tops[-1].select("tree", F.lit("").alias("subroot"), F.col("hash").alias("root"), F.expr("array()").cast("array<struct<left:string,right:string>>").alias("path"))
    ways = descend(above.withColumnRenamed("subroot", "own"), _paths(tops, root, fanout, levels, "top-paths"), fanout, levels)
    ways = stage(ways.select(F.col("name").alias("tree"), F.col("own").alias("subroot"), "root", "path"), "ways")
    found = descend(rows.drop("n", "row"), _paths(pivots, ways, fanout, levels, "paths"), fanout, levels)
    step = lambda held, s: F.sha2(F.concat(s["left"], held, s["right"]), 256)
    sides = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate("path", F.coalesce("bad", "leaf"), step)
    out = found.select("doc_id", "leaf", "subroot", "root", F.sha2(sides, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_PART = "coalesce(octet_length(encode({0}))::VARCHAR || ':' || {0}, '-')"
_LEAF = " || ".join(_PART.format(x) for x in ("doc_id::VARCHAR", "source", "lang", "{n}::VARCHAR", "text"))
_CRC = """(SELECT list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::UBIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: 0::UBIGINT)),
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)))"""
_STEP = "list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))"
ORACLE = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, lang, sha256({_LEAF.format(n="n_chars")}) AS leaf, sha256({_LEAF.format(n="(n_chars + 1)")}) AS changed,
         xor({_CRC}, 4294967295::UBIGINT) % 7 = 0 AS hit, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos
  FROM documents),
tree(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY doc_id) FROM d GROUP BY lang
  UNION ALL SELECT lang, level + 1, {_STEP} FROM tree WHERE len(nodes) > 1),
subs AS MATERIALIZED (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos FROM tree WHERE len(nodes) = 1),
top(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY pos) FROM subs
  UNION ALL SELECT level + 1, {_STEP} FROM top WHERE len(nodes) > 1),
sides AS (
  SELECT doc_id, level, CAST(pos >> level AS BIGINT) AS spot, nodes FROM d JOIN tree ON tree.lang IS NOT DISTINCT FROM d.lang AND len(nodes) > 1
  UNION ALL
  SELECT doc_id, 100 + level, CAST(s.pos >> level AS BIGINT), nodes FROM d JOIN subs s ON s.lang IS NOT DISTINCT FROM d.lang CROSS JOIN top WHERE len(nodes) > 1),
paths AS (
  SELECT doc_id, list(CASE WHEN spot % 2 = 1 THEN 'L' || nodes[spot] ELSE 'R' || coalesce(nodes[spot + 2], '') END ORDER BY level) AS path
  FROM sides GROUP BY doc_id),
folded AS (
  SELECT d.doc_id, leaf, subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root, coalesce(path, []) AS path,
         CASE WHEN hit THEN changed ELSE leaf END AS start
  FROM d JOIN subs ON subs.lang IS NOT DISTINCT FROM d.lang LEFT JOIN paths ON paths.doc_id = d.doc_id)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: substr(s, 2)), '')) AS proof_sha256,
       list_reduce(list_prepend(start, path), lambda h, s: sha256(CASE WHEN s[1] = 'L' THEN substr(s, 2) || h ELSE h || substr(s, 2) END)) AS folded_root,
       folded_root = root AS verified
FROM folded"""
