"""Exact top-k search by inner product, block at a time.

Vectors are put in an order that brings similar ones together (by the nearest of a few pivots and the product with it) and cut into
ranges, the blocks. A block has the maxima of its terms, a term being a component and a sign, and a forward index: its vectors
as rows of a matrix. For a query the maxima, weighed with its components and summed, bound every score in a block. Blocks are taken in the
order of their bounds, each scored through its forward index, until the bounds fall below the k-th best score so far; a
block whose bound equals it is still scored, since ties go to the smaller vec_id.

Blocks in sequence make shards, queries are dealt to chunks, and a task holds one chunk and one shard, both of bounded size. Each query first
meets its own shard, which gives a k-th score that every other shard has to reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.llm.common import placed, stage
from feedfold.llm.integer_vectors import integer_vectors, list_array, matrix

SCALE, EVERY, TOP = 1024, 100, 10
BLOCK, STEP, PIVOTS = 32, 16, 64
SHARD_ROWS, CHUNK_ROWS = 4096, 4096
LOW = -(1 << 62)  # below any score: integer_vectors bounds them by 2 ** 60


def _rows(most: int) -> Column:
    """Rows of a shard or chunk: `most`, fewer where vectors are so long that a task would hold more than 2 ** 20 numbers of them."""
    return F.greatest(F.lit(BLOCK), F.least(F.lit(most), F.floor(F.lit(1 << 20) / F.col("dim") / BLOCK) * BLOCK)).cast("int")


def search(queries: np.ndarray, own: np.ndarray, floor: np.ndarray, forward: np.ndarray, place: np.ndarray, rank: np.ndarray, high: np.ndarray, low: np.ndarray, top: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query, block-and-row and score of the best rows of each query, `top` at most and none under its floor, and the blocks scored.

    queries (q, d) with their places; blocks' forward (b, r, d), place and rank (b, r), high and low (b, d). A query's own row has its
    place; absent rows have place -1. Of equal scores the row of smaller rank is better.
    """
    floats = queries.shape[1] * float(max(np.abs(queries).max(initial=0), 1)) * float(max(np.abs(forward).max(initial=0), 1)) < 2**53
    kind = np.float64 if floats else np.int64  # float products are exact below 2 ** 53, and fast
    q, f = queries.astype(kind), forward.astype(kind)
    bounds = (np.maximum(q, 0) @ high.T.astype(kind) + np.minimum(q, 0) @ low.T.astype(kind)).astype(np.int64)
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth, scored = floor.copy(), 0
    who, where, best = (np.empty(0, np.int64) for _ in range(3))
    rows = forward.shape[1]
    for at in range(0, len(forward), step):
        some = order[:, at : at + step]
        live = np.take_along_axis(bounds, some, 1) >= kth[:, None]
        if not live.any():
            break
        qi, k = np.nonzero(live)
        block = some[qi, k]
        by = np.argsort(block, kind="stable")
        qi, block = qi[by], block[by]
        scored += len(qi)
        got = np.empty((len(qi), rows), np.int64)
        cuts = np.flatnonzero(np.diff(block)) + 1
        for i, j in zip([0, *cuts], [*cuts, len(block)]):
            got[i:j] = q[qi[i:j]] @ f[block[i]].T
        there = place[block]
        got[(there < 0) | (there == own[qi][:, None])] = LOW
        i, j = np.nonzero((got >= kth[qi][:, None]) & (got > LOW))
        who, where, best = np.concatenate((who, qi[i])), np.concatenate((where, block[i] * rows + j)), np.concatenate((best, got[i, j]))
        by = np.lexsort((rank.ravel()[where], -best, who))
        who, where, best = who[by], where[by], best[by]
        nth = np.arange(len(who)) - np.searchsorted(who, who)
        last = nth == top - 1
        kth[who[last]] = np.maximum(kth[who[last]], best[last])
        keep = nth < top
        who, where, best = who[keep], where[keep], best[keep]
    return who, where, best, scored


def _index(ranked: DataFrame) -> DataFrame:
    """dim, shard, block, vec_ids, places, forward, high and low of every block."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        dim, rows = key[0].as_py(), rows.sort_by("pos").combine_chunks()
        x, pos = matrix(rows["ints"], dim), rows["pos"].to_numpy()
        ids = rows["vec_id"].combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        starts = np.arange(0, len(pos), BLOCK)
        sizes = np.minimum(BLOCK, len(pos) - starts)
        ends = pa.array(np.concatenate((starts, [len(pos)])).astype(np.int32))
        n, wide = len(starts), np.full(len(starts), dim)
        return pa.table({
            "dim": pa.array([dim] * n, pa.int32()), "shard": pa.array([key[1].as_py()] * n, pa.int64()), "block": pa.array(np.arange(n), pa.int32()),
            "vec_ids": pa.ListArray.from_arrays(ends, ids), "places": pa.ListArray.from_arrays(ends, pa.array(pos)), "forward": list_array(x.ravel(), sizes * dim, pa.int64()),
            "high": list_array(np.maximum.reduceat(x, starts).ravel(), wide, pa.int64()), "low": list_array(np.minimum.reduceat(x, starts).ravel(), wide, pa.int64()),
        })

    made = "dim int, shard long, block int, vec_ids array<long>, places array<long>, forward array<long>, high array<long>, low array<long>"
    return ranked.select("dim", "shard", "pos", "vec_id", "ints").groupBy("dim", "shard").applyInArrow(run, made)


FOUND = "dim long, place long, query_id long, vec_id long, other long, score long, blocks long, scored long"


def _searched(index: DataFrame, queries: DataFrame, keys: list[str], top: int) -> DataFrame:
    """Candidates (place of the query, its id, vec_id, place of the row, score) of the queries and blocks that share keys."""

    def run(key: tuple, blocks: pa.Table, asked: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in FOUND.split(", ")]
        if not blocks.num_rows or not asked.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        dim, blocks = key[0].as_py(), blocks.sort_by("block")
        sizes = pc.list_value_length(blocks["places"]).to_numpy()
        full = np.arange(BLOCK) < sizes[:, None]
        forward = np.zeros((len(sizes), BLOCK, dim), np.int64)
        forward[full] = matrix(blocks["forward"], dim)
        place, rank = np.full(full.shape, -1), np.zeros(full.shape, np.int64)
        place[full] = pc.list_flatten(blocks["places"]).to_numpy()
        ids = pc.list_flatten(blocks["vec_ids"])
        # smaller vec_id first, null last, then by place
        rank[full] = np.argsort(np.lexsort((place[full], pc.fill_null(ids, 0).to_numpy(), pc.is_null(ids).to_numpy(zero_copy_only=False))))
        own, floor = asked["pos"].to_numpy(), pc.fill_null(asked["floor"], LOW).to_numpy()
        who, where, best, scored = search(matrix(asked["ints"], dim), own, floor, forward, place, rank, matrix(blocks["high"], dim), matrix(blocks["low"], dim), top)
        at = np.full(full.size, -1)
        at[np.flatnonzero(full.ravel())] = np.arange(full.sum())
        n = len(who)
        work = np.zeros((2, n), np.int64)
        work[:, :1] = [[len(own) * len(sizes)], [scored]]  # what the task had and scored, on its first row
        return pa.table([pa.array(np.full(n, dim)), pa.array(own[who]), asked["vec_id"].take(pa.array(who)), ids.take(pa.array(at[where])), pa.array(place.ravel()[where]), pa.array(best), *(pa.array(w) for w in work)], names=names)

    there = index.groupBy(*keys)
    return there.cogroup(queries.select(*keys, "pos", "vec_id", "ints", "floor").groupBy(*keys)).applyInArrow(run, FOUND)


def candidates(vectors: DataFrame, scale: int = SCALE, every: int = EVERY, top: int = TOP) -> DataFrame:
    """Each shard's best rows for each query that reach the query's floor; staged. `blocks` and `scored` add up to the blocks met and scored."""
    held = vectors.select(F.col("`vec_id`").try_cast("long").alias("vec_id"), F.col("`embedding`").alias("embedding"))
    base = stage(integer_vectors(held, scale), "integers")
    first = base.orderBy(F.col("vec_id").asc_nulls_last(), "row").limit(PIVOTS).select("dim", "ints").collect()  # at most PIVOTS vectors
    wide = first[0]["dim"] if first else 0
    pivots = np.array([r["ints"] for r in first if r["dim"] == wide], float)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, product = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            own = batch.column(2).to_numpy() == wide
            if own.any():
                s = matrix(batch.column(3).filter(pa.array(own)), wide) @ pivots.T
                near[own], product[own] = s.argmax(1), s.max(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near), pa.array(product)], names=[*batch.schema.names, "near", "product"])

    f = base.schema.fields
    located = base.mapInArrow(locate, T.StructType([*f, T.StructField("near", T.IntegerType()), T.StructField("product", T.DoubleType())]))
    ranked = placed(located, "dim", ["near", F.desc("product"), "vec_id", "row"], "ranked")
    ranked = ranked.withColumn("shard", F.floor(F.col("pos") / _rows(SHARD_ROWS)))
    index = stage(_index(ranked), "blocks")
    queries = stage(ranked.where(F.col("vec_id") % every == 0).select("dim", "shard", "pos", "n", "vec_id", "ints"), "queries")
    home = _searched(index, queries.withColumn("floor", F.lit(None).cast("long")), ["dim", "shard"], top)
    floors = home.groupBy(F.col("dim").cast("int").alias("dim"), F.col("place").alias("pos")).agg(F.min("score").alias("floor"), F.count("*").alias("held"))
    known = queries.join(floors.where(F.col("held") >= top).drop("held"), ["dim", "pos"], "left")
    chunks = queries.groupBy("dim").agg(F.ceil(F.count("*") / _rows(CHUNK_ROWS)).cast("int").alias("chunks"))
    met = known.join(chunks, "dim").withColumn("chunk", F.pmod(F.xxhash64("pos"), F.col("chunks")).cast("int"))
    met = met.withColumn("shard", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / _rows(SHARD_ROWS)))))
    sent = index.join(chunks, "dim").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return stage(_searched(sent, met, ["dim", "chunk", "shard"], top), "candidates")


def top_k(vectors: DataFrame, scale: int = SCALE, every: int = EVERY, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the best rows for each query, a row whose vec_id `every` divides, among all rows but its own.

    Vectors take part as integer_vectors says; those of different lengths have no product and do not meet. A row that repeats a vec_id is a query
    and a candidate of its own. A vec_id that is null or no integer is a candidate only, the last of a tie. Other columns are not read;
    an empty table gives no rows.
    """
    found = candidates(vectors, scale, every, top)
    order = Window.partitionBy("place", "dim").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "other")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(range(1, len(v.x) + 1), lambda i: q.x[i] * v.x[i])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10"""
