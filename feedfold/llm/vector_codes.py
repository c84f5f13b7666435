"""Vector code compression: product codes trained by Lloyd rounds that compare only what can have changed.

Vectors of integers are cut into equal parts, each with a codebook. Besides its entry each part keeps the exact distance to it. After a
round has moved some entries, a part whose entry stayed fixed is compared with the moved entries only: all others were no
nearer before and are where they were. A part whose entry moved is compared with the whole codebook. Of equal distances the lower
index wins in both cases, so the outcome is that of full comparisons.

Codebooks (at most `entries` rows of a vector's length) go to the executors with the task; what comes back per round are sums and counts per
entry, added up by Spark. The state of a round is a staged table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.llm.common import stage, with_group
from feedfold.llm.integer_vectors import integer_vectors, list_array, matrix

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
CHUNK = 1024


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, exact, of parts (n, w) to entries (k, w)."""
    return np.square(x[:, None, :] - book[None, :, :]).sum(2)


def scan(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and its distance of each part, the lower index of equal ones."""
    d = distances(x, book)
    entry = d.argmin(1)
    return entry, d[np.arange(len(x)), entry]


def advance(x: np.ndarray, entry: np.ndarray, dist: np.ndarray, book: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """scan() of parts that had these entries at these distances before some entries moved, and how many distances that took."""
    entry, dist, active = entry.copy(), dist.copy(), np.flatnonzero(moved)
    lost = moved[entry]
    again, calm = np.flatnonzero(lost), np.flatnonzero(~lost)
    if len(again):
        entry[again], dist[again] = scan(x[again], book)
    if len(calm) and len(active):
        near, d = scan(x[calm], book[active])
        near = active[near]
        better = (d < dist[calm]) | ((d == dist[calm]) & (near < entry[calm]))
        entry[calm[better]], dist[calm[better]] = near[better], d[better]
    return entry, dist, len(again) * len(book) + len(calm) * len(active)


def _assigned(state: DataFrame, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """The state with entry, dist and compared (distances taken) after a comparison with books (parts, entries, width)."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                n = batch.num_rows
                x = matrix(batch.column(3), parts * width).reshape(n, parts, width)
                entry, dist, taken = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64), 0
                if moved is not None:
                    old_entry, old_dist = matrix(batch.column(4), parts), matrix(batch.column(5), parts)
                for p in range(parts):
                    if moved is None:
                        entry[:, p], dist[:, p] = scan(x[:, p], books[p])
                        taken += n * len(books[p])
                    else:
                        entry[:, p], dist[:, p], more = advance(x[:, p], old_entry[:, p].astype(np.int64), old_dist[:, p], books[p], moved[p])
                        taken += more
                size = np.full(n, parts)
                took = np.zeros(n, np.int64)
                took[:1] = taken
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:4], list_array(entry.ravel(), size, pa.int32()), list_array(dist.ravel(), size, pa.int64()), pa.array(took)],
                    names=["row", "vec_id", "label", "ints", "entry", "dist", "compared"],
                )

    f = {x.name: x for x in state.schema.fields}
    made = [*(f[c] for c in ("row", "vec_id", "label", "ints")), T.StructField("entry", T.ArrayType(T.IntegerType())), T.StructField("dist", T.ArrayType(T.LongType())), T.StructField("compared", T.LongType())]
    held = ["row", "vec_id", "label", "ints", *(["entry", "dist"] if moved is not None else [])]
    return state.select(*held).mapInArrow(run, T.StructType(made))


def _means(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The books with each used entry replaced by the rounded-down mean of its parts. The driver gets one sum per number of the books."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            x, entry = matrix(batch.column(0), parts * width).reshape(-1, parts, width), matrix(batch.column(1), parts)
            for p in range(parts):
                np.add.at(sums[p, :, 0], entry[:, p], 1)
                np.add.at(sums[p, :, 1:], entry[:, p], x[:, p])
        flat = sums.ravel()
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(flat[some], pa.int64())], names=["at", "x"])

    found = state.select("ints", "entry").mapInArrow(run, "at long, x long").groupBy("at").agg(F.sum("x").alias("x"))
    sums = np.zeros((parts, entries, width + 1), np.int64)
    for at, x in found.collect():  # parts * entries * (width + 1) numbers at most
        sums.ravel()[at] = x
    out, used = books.copy(), sums[:, :, 0] > 0
    out[used] = sums[used][:, 1:] // sums[used][:, :1]
    return out


def train(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame | None, np.ndarray]:
    """The final state (row, vec_id, label, ints, entry, dist, compared), staged, and the final books (parts, entries, width); None without vectors."""
    base = stage(integer_vectors(vectors, scale, "label"), "vectors")
    order = [F.col("vec_id").asc_nulls_last(), "ints", "row"]
    first = base.orderBy(*order).select("dim").first()
    if first is None:
        return None, np.zeros((parts, 0, 0), np.int64)
    dim = first["dim"]
    width = -(-dim // parts)
    full = base.where(F.col("dim") == dim)
    if width * parts > dim:
        full = full.withColumn("ints", F.concat("ints", F.array_repeat(F.lit(0).cast("long"), width * parts - dim)))
    start = [r["ints"] for r in full.orderBy(*order).select("ints").limit(entries).collect()]  # at most `entries` vectors
    books = np.array(start, np.int64).reshape(len(start), parts, width).swapaxes(0, 1).copy()
    state = stage(_assigned(full, books, None), "codes-0")
    for k in range(rounds):
        after = _means(state, books)
        moved = (after != books).any(2)
        books = after
        state = stage(_assigned(state, books, moved), f"codes-{k + 1}")
    return state, books


def compress(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of the rows of vectors that take part (see integer_vectors).

    All vectors have the length of that with the smallest vec_id (null last); others take no part. A length that the parts do not divide is
    filled up with zeros, which change no distance. Rows that repeat a vec_id are coded each for itself; where fewer vectors than entries
    exist, that many entries do. Labels are equal as text, nulls are one label; a sum that no long holds is null. An empty table gives no rows.
    """
    state, books = train(vectors, scale, parts, entries, rounds)
    if state is None:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("entry", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    error = F.aggregate("dist", F.lit(0).cast("long"), lambda a, d: a + d)
    label = F.col("label").cast("string")
    rows = state.select("row", "vec_id", code.alias("code"), error.alias("error"), label.isNull().alias("bare"), F.coalesce(label, F.lit("")).alias("named"))
    grouped = with_group(rows, ["bare", "named"], ["row"], {"label_error": F.try_sum("error")})
    return grouped.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle() -> str:
    def nearest(name: str, book: str) -> str:
        distance = " + ".join(f"(x.v[{i}] - b.v[{i}]) * (x.v[{i}] - b.v[{i}])" for i in range(1, 5))
        return f"""{name} AS MATERIALIZED (
  SELECT vec_id, part, v, least.e AS e, least.d AS d FROM (
    SELECT x.vec_id, x.part, any_value(x.v) AS v, min(struct_pack(d := {distance}, e := b.e)) AS least
    FROM parts x JOIN {book} b ON b.part = x.part GROUP BY x.vec_id, x.part))"""

    def means(name: str, book: str, held: str) -> str:
        mean = ", ".join(f"CAST(floor(sum(v[{i}]) / count(*)) AS BIGINT)" for i in range(1, 5))
        return f"""{name} AS MATERIALIZED (
  SELECT b.part, b.e, coalesce(m.v, b.v) AS v FROM {book} b LEFT JOIN (SELECT part, e, [{mean}] AS v FROM {held} GROUP BY part, e) m
  ON m.part = b.part AND m.e = b.e)"""

    return f"""
WITH ints AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, part, v[part * 4 + 1 : part * 4 + 4] AS v FROM ints CROSS JOIN range(16) r(part)),
b0 AS MATERIALIZED (
  SELECT part, e, v FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM ints QUALIFY e < 64) USING (vec_id)),
{nearest("a0", "b0")},
{means("b1", "b0", "a0")},
{nearest("a1", "b1")},
{means("b2", "b1", "a1")},
{nearest("a2", "b2")},
coded AS (
  SELECT vec_id, string_agg(format('{{:02x}}', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, e)) FROM b2) AS codebooks_sha256
FROM coded JOIN ints USING (vec_id)"""


ORACLE = _oracle()
