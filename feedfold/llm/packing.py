"""Packing along a Hilbert curve.

A document is its token ids plus an end id. Hashed counts of its ids are projected to a few dimensions, the point's
place on a Hilbert curve is its key, and documents in key order, laid end to end, are cut every `length` ids. So
neighbours on the curve share sequences, and only the last sequence of all can be short. Packing a mix, documents go by
ranges of RUN_SLOTS slots of the schedule (see mixing) first, by the curve within each, so that target weights reach every run of sequences.

Ids are tokenized once and staged. Keys alone are range-sorted to give each document its place; then each task cuts its own documents.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedfold.llm import mixing
from feedfold.llm.common import placed, stage

LENGTH = 2048
END_ID = 1
FEATURES, DIMS, BITS = 1024, 4, 12
RUN_SLOTS = 64


class Tokens:
    """Token ids of texts by a tokenizers file.

    `ranks` may name a tiktoken file of the same vocabulary and its pattern: the same ids, a few times faster. What only the
    tokenizers file knows, texts that hold its added tokens, and what tiktoken refuses goes through tokenizers all the same.
    """

    def __init__(self, path: str, ranks: tuple[str, str] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        self.path, self.slow, self.fast, self.added = path, None, None, None
        if ranks is not None:
            import tiktoken

            with open(ranks[0], "rb") as lines:
                merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=ranks[1], mergeable_ranks=merges, special_tokens={})
            with open(path, encoding="utf-8") as text:
                added = [t["content"] for t in json.load(text).get("added_tokens", [])]
            self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not self.added.search(text):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except (ValueError, RuntimeError):
                pass
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points (n, dims), each coordinate of `bits` bits."""
    x = points.astype(np.uint64).T.copy()
    one = np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > one:  # undo the rotations and reflections of each level, from the coarsest
        low = q - one
        for i in range(len(x)):
            high = (x[i] & q) > 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, len(x)):  # Gray code to number
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = one << np.uint64(bits - 1)
    while q > one:
        flip = np.where((x[-1] & q) > 0, flip ^ (q - one), flip)
        q >>= one
    x ^= flip
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for row in x:
            key = (key << one) | ((row >> np.uint64(b)) & one)
    return key.astype(np.int64)


class Curve:
    """Hilbert keys of id arrays, by a fixed random projection of hashed, damped counts."""

    def __init__(self, seed: int = 3):
        self.axes = np.random.default_rng(seed).normal(0, 1, (FEATURES, DIMS))

    def point(self, ids: np.ndarray) -> np.ndarray:
        hashed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)
        v = np.sqrt(np.bincount(hashed.astype(np.int64), minlength=FEATURES))
        norm = np.linalg.norm(v)
        z = v @ self.axes / norm if norm else np.zeros(DIMS)
        return np.clip((1 / (1 + np.exp(-1.7 * z))) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)

    def keys(self, all_ids: list[np.ndarray]) -> np.ndarray:
        return hilbert(np.array([self.point(i) for i in all_ids]).reshape(-1, DIMS), BITS)


def tokenized(docs: DataFrame, tokenizer: str, *more: str, ranks: tuple[str, str] | None = None) -> DataFrame:
    """row, doc_id, key, tokens (with the end id), ids (16-bit where all fit, else 32-bit) and more columns of every row of docs; staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, curve, end = Tokens(tokenizer, ranks), Curve(), np.array([END_ID], np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [np.concatenate((tokens.ids(t.as_py() or ""), end)) for t in part.column(2)]
                packed = [i.astype("<u2").tobytes() if i.max() < 65536 else i.astype("<u4").tobytes() for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(curve.keys(ids), pa.int64()), pa.array([len(i) for i in ids], pa.int64()), pa.array(packed, pa.binary()), *part.columns[3:]],
                    names=["row", "doc_id", "key", "tokens", "ids", *more],
                )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", *more)
    kinds = {"row": "long", "doc_id": docs.schema["doc_id"].dataType.simpleString(), "key": "long", "tokens": "long", "ids": "binary"}
    kinds |= {c: docs.schema[c].dataType.simpleString() for c in more}
    return stage(rows.mapInArrow(run, ", ".join(f"{c} {k}" for c, k in kinds.items())), "tokens")


def places(rows: DataFrame) -> DataFrame:
    """row and first: how many ids come before each row in the order of run and key. The driver sees one sum per partition."""
    ordered = stage(rows.select("row", "doc_id", "run", "key", "tokens").orderBy("run", "key", "doc_id", "row").withColumn("part", F.spark_partition_id()), "order")
    sums = sorted((r["part"], r["n"]) for r in ordered.groupBy("part").agg(F.sum("tokens").alias("n")).collect())
    before, total = {}, 0
    for part, n in sums:
        before[part], total = total, total + n
    spark = rows.sparkSession
    starts = spark.createDataFrame(list(before.items()), "part int, before long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = None, 0
        for batch in batches:
            parts, n, base = (batch.column(i).to_numpy() for i in (1, 2, 3))
            first = np.empty(len(n), np.int64)
            for i in range(len(n)):
                if parts[i] != part:
                    part, at = parts[i], base[i]
                first[i] = at
                at += n[i]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first)], names=["row", "first"])

    # one row per sorted partition goes to the rows of that partition, in their order
    keyed = ordered.join(F.broadcast(starts), "part").repartition(max(len(before), 1), "part").sortWithinPartitions("part", "run", "key", "doc_id", "row")
    return keyed.select("row", "part", "tokens", "before").mapInArrow(run, "row long, first long")


def in_written_order(docs: DataFrame) -> DataFrame | None:
    """docs with _file and _place, by which rows stand as they were written; None where docs is no table of Parquet files."""
    try:
        return docs.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    except AnalysisException:
        return None


def pack(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, mixed: bool = False, run_slots: int = RUN_SLOTS, ranks: tuple[str, str] | None = None, kept_rows: int | None = None
) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian 32-bit).

    A null or empty text is its end id alone. Repeated rows and null ids are documents like others, in order of key, doc_id and place in
    the table; an empty table gives no pieces. Columns besides doc_id and text are not read. With mixed, source is read, and documents
    go by ranges of run_slots slots of the schedule that mixing gives the table, then by key. With kept_rows they go by ranges of so many
    rows in the order in which their table was written, so that an order given to it reaches the sequences. `ranks`: see Tokens.
    """
    written = in_written_order(docs) if kept_rows else None
    if kept_rows and written is None:
        raise ValueError("only a table of Parquet files has a written order")
    more = ["_file", "_place"] if kept_rows else ["source"] * mixed
    rows = tokenized(docs if written is None else written, tokenizer, *more, ranks=ranks)
    ranked = rows.select("row", "doc_id", "key", "tokens", *more)
    if kept_rows:
        # names of part files are numbers of at least five digits, so longer ones are later
        order = [F.length("_file"), "_file", "_place"]
        ranked = placed(ranked.withColumn("_all", F.lit("")), "_all", order, "written").withColumn("run", F.floor(F.col("pos") / kept_rows))
    elif mixed:
        ranked = mixing.schedule(ranked, F.col("source"), F.col("doc_id")).withColumn("run", F.floor(F.col("_slot") / run_slots))
    else:
        ranked = ranked.withColumn("run", F.lit(0))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for from_ in range(0, batch.num_rows, 128):
                part = batch.slice(from_, 128)
                out: list[tuple] = []
                for doc, n, ids, first in zip(*(part.column(i).to_pylist() for i in range(4))):
                    data = ids if len(ids) == 4 * n else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                    at = 0
                    while at < n:
                        offset = (first + at) % length
                        take = min(length - offset, n - at)
                        out.append((doc, at, take, n, (first + at) // length, offset, data[4 * at : 4 * (at + take)]))
                        at += take
                cols = list(zip(*out)) or [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], part.schema.field(0).type), *(pa.array(c, pa.int64()) for c in cols[1:6]), pa.array(cols[6], pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    joined = rows.select("row", "doc_id", "tokens", "ids").join(places(ranked), "row")
    return joined.select("doc_id", "tokens", "ids", "first").mapInArrow(
        run, f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
