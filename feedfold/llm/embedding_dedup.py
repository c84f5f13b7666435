"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosines, connected components.

Vectors with equal signs in a table share a bucket. A bucket's rows are dealt into small cells by a hash; pairs of
cells are compared by matrix products inside tasks, so a bucket of any size is many bounded tasks and pairs of
vectors are never rows. A pair that shares buckets in several tables counts in the first of them. What leaves a task is the
number of links per vector and a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import components, join_spread, stage, with_group

LEAST = 0.9
TABLES, BITS = 20, 10  # at a cosine of 0.9: 0.857 ** 10 a table, missed in all with a chance of 1.5 %
CELL_ROWS = 256
TOGETHER = 64  # buckets of one cell that a call compares, each for itself: at most 64 * 256 rows


def _planes(dim: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng(29).normal(0, 1, (dim, tables * bits))


def hashed(vectors: DataFrame, tables: int, bits: int) -> DataFrame:
    """vec_id, vector (doubles) and signs (one number per table) of every comparable vector.

    A vector of another length than its neighbours is hashed by planes of its own length and compared with its equals only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        scale = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                ids, vecs, signs = [], [], []
                for i, v in zip(batch.column(0).slice(at, 1024).to_pylist(), batch.column(1).slice(at, 1024).to_pylist()):
                    if i is None or not v or None in v:
                        continue
                    x = np.array(v, float)
                    top = np.abs(x).max() if np.isfinite(x).all() else 0.0
                    if not top:
                        continue
                    x = x / top
                    x /= np.linalg.norm(x)
                    if len(x) not in planes:
                        planes[len(x)] = _planes(len(x), tables, bits)
                    ids.append(i)
                    vecs.append(x)
                    signs.append(((x @ planes[len(x)]) >= 0).reshape(tables, bits) @ scale)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.list_(pa.float64())), pa.array(signs, pa.list_(pa.int64()))], names=["vec_id", "vector", "signs"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, vector array<double>, signs array<long>")


def _compare(left: pd.DataFrame, right: pd.DataFrame, same: bool, table: int, least: float) -> pd.DataFrame:
    """Of two cells: per vector its links, and edges of a forest that connects what they connect. `n` weighs classes of equal vectors."""
    a, b = np.stack(left.vector), np.stack(right.vector)
    hit = a @ b.T >= least - 1e-9
    if same:
        hit = np.triu(hit, 1)
    if table:
        sa, sb = np.stack(left.signs)[:, :table], np.stack(right.signs)[:, :table]
        for k in range(table):
            hit &= sa[:, None, k] != sb[None, :, k]
    i, j = np.nonzero(hit)
    exact = np.einsum("ij,ij->i", a[i], b[j]) >= least
    i, j = i[exact], j[exact]
    na, nb = left.n.to_numpy(), right.n.to_numpy()
    ids = np.concatenate((left.vec_id.to_numpy(), right.vec_id.to_numpy()))
    gain = np.zeros(len(ids), np.int64)
    np.add.at(gain, i, nb[j])
    np.add.at(gain, j + len(left), na[i])
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    edges = []
    for u, v in zip(ids[i], ids[j + len(left)]):
        p, q = find(u), find(v)
        if p != q:
            root[p] = q
            edges.append((u, v, 0))
    some = np.nonzero(gain)[0]
    return pd.DataFrame([*edges, *((ids[k], None, gain[k]) for k in some)], columns=["a", "b", "links"], dtype=object)


def near_vectors(vectors: DataFrame, least: float = LEAST, tables: int = TABLES, bits: int = BITS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; a null vec_id has a null component
    and is kept. Equal vectors are compared once and count as often as they occur. Only vectors of one length are compared.
    Rows that repeat a vec_id are vectors of their own that share a node: each adds its links. Labels are not read; an empty table gives no rows.
    """
    base = stage(hashed(vectors, tables, bits).withColumn("same", F.sha2(F.array_join(F.col("vector").cast("array<string>"), ","), 256)), "vectors")
    classed = with_group(base, ["same"], ["vec_id"], {"first": F.min("vec_id"), "n": F.count("*")})
    classed = stage(classed.select("vec_id", "same", "first", "n"), "classes")
    heads = stage(base.join(classed.where("vec_id = first").dropDuplicates(["same"]).select("same", "n"), "same").dropDuplicates(["same"]), "heads")
    spread = heads.select("same", F.size("vector").alias("dim"), F.posexplode("signs").alias("table", "bucket"))
    sizes = with_group(spread, ["dim", "table", "bucket"], ["same"], {"size": F.count("*")}).where("size > 1")
    cells = sizes.withColumn("cells", F.ceil(F.col("size") / CELL_ROWS).cast("int"))
    cells = stage(cells.withColumn("cell", F.pmod(F.xxhash64("same", F.lit(3)), F.col("cells")).cast("int")), "cells")
    # each cell goes once to each pair of cells that it is in
    other = F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("other")
    pack = F.when(F.col("cells") == 1, -1 - F.floor(F.col("bucket") / TOGETHER)).otherwise(F.col("bucket")).alias("pack")
    pairs = cells.select("same", "dim", "table", "bucket", pack, "cell", other).select(
        "same", "dim", "table", "bucket", "pack", F.least("cell", "other").alias("lo"), F.greatest("cell", "other").alias("hi"), "cell"
    )
    full = pairs.join(heads.select("same", "vec_id", "vector", "signs", "n"), "same")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if key[2] < 0:
            rows = rows.sort_values("bucket", kind="stable")
            cuts = np.flatnonzero(np.diff(rows.bucket.to_numpy())) + 1
            bounds = zip([0, *cuts], [*cuts, len(rows)])
            return pd.concat([_compare(part, part, True, key[1], least) for part in (rows.iloc[i:j] for i, j in bounds)])
        lo, hi = rows[rows.cell == key[3]], rows[rows.cell == key[4]]
        if not len(lo) or not len(hi):
            return pd.DataFrame({"a": [], "b": [], "links": []})
        return _compare(lo, hi, key[3] == key[4], key[1], least)

    found = stage(full.groupBy("dim", "table", "pack", "lo", "hi").applyInPandas(compare, "a long, b long, links long"), "found")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    edges = found.where("b IS NOT NULL").select("a", "b").unionByName(classed.select(F.col("vec_id").alias("a"), F.col("first").alias("b")))
    parts = components(edges, "a", "b")
    # a class's links count for each of its vectors; its other members are links, too
    first = heads.select("same", F.col("vec_id").alias("a")).join(counts, "a", "left").select("same", F.coalesce("links", F.lit(0)).alias("links"))
    members = join_spread(classed.select("vec_id", "same", "n"), first, ["same"], ["vec_id"])
    own = members.groupBy("vec_id").agg(F.sum(F.col("links") + F.col("n") - 1).alias("links"))
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(own, "vec_id", "left").join(parts.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
