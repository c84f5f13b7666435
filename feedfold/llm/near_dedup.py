"""Near duplicates by MinHash: many universal hash minima, banding, exact verification, large-star and small-star.

Equal shingle sets are one class, of which one row goes on. Rows that share a band of minima share a bucket. Within
a bucket not all pairs are tested. First each row is tested against the bucket's reference p, the most central row among its
rows and their neighbours. Whatever p is: if two rows x, y are similar, then either all they share is in p, so both share enough
with p, which the tests have counted; or they share a shingle that p lacks, and such shingles are buckets of their own, where a row can share no more than
it has of p and of the shingles that p lacks and another row has. So pairs are tested only where one of the two holds, these counts leave room and
components differ, by growing blocks of rows outside a bucket's largest component; no similar pair of a bucket is
lost, and a large group of near copies, with a passage of their own or not, stays far from all its pairs. Tests compare full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedfold.llm.common import join_spread, named, stage, stars, with_group

SHINGLE = 4
BANDS, ROWS = 32, 6  # a pair at 0.8 shares no bucket with a chance of 6e-5
PER_CENT = 80
BLOCK = 1024
ANY = 1 << 40
SHARES = 64
CACHE_WORDS = 400_000
_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def words(text: str | None) -> list[bytes]:
    """Runs of anything but the six ASCII white-space characters, A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingle_set(text: str | None, size: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """Distinct runs of `size` words; with fewer words all of them as one; without words nothing."""
    w = words(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(size))))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _P[1]
    x = (x ^ (x >> np.uint64(29))) * _P[4]
    return x ^ (x >> np.uint64(32))


class Hasher:
    """64-bit hashes of a text's distinct shingles; words are hashed once while they are in the cache."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.cache = size, {}

    def word_codes(self, ws: list[bytes]) -> np.ndarray:
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for w in set(ws).difference(cache):
            cache[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(cache.__getitem__, ws), np.uint64, len(ws))

    def runs(self, ws: list[bytes]) -> np.ndarray:
        """Hashes of all runs of `size` words, in order."""
        return self.runs_of(self.word_codes(ws))

    def runs_of(self, c: np.ndarray) -> np.ndarray:
        """The same, of words that are hashed already."""
        n = max(0, len(c) - self.size + 1)
        h = np.zeros(n, np.uint64)
        for k in range(self.size):
            h = h * _P[0] + c[k : k + n]
        return _mix(h)

    def distinct(self, ws: list[bytes]) -> np.ndarray:
        if not ws:
            return np.empty(0, np.uint64)
        if len(ws) < self.size:
            return np.array([xxhash.xxh64_intdigest(b" ".join(ws), seed=len(ws))], np.uint64)
        return np.unique(self.runs(ws))


class Signer:
    """Band keys from the minima of bands * rows functions a * x + b modulo 2^64, a odd."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, bands * rows, np.uint64)

    def minima(self, x: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(x), 2048):
            part = self.a[:, None] * x[None, at : at + 2048]
            part += self.b[:, None]
            np.minimum(low, part.min(1), out=low)
        return low

    def keys(self, x: np.ndarray) -> np.ndarray:
        m = _mix(self.minima(x)).reshape(self.bands, self.rows)
        h = np.arange(1, self.bands + 1, dtype=np.uint64)
        for k in range(self.rows):
            h = _mix(h * _P[2] + m[:, k])
        return h.view(np.int64)


def signatures(docs: DataFrame, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_key (null without words), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, signer = Hasher(size), Signer(bands, rows)
        for batch in batches:
            n, key, band = [], [], []
            for t in batch.column(1):
                x = hasher.distinct(words(t.as_py()))
                n.append(len(x))
                key.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                band.append(signer.keys(x) if len(x) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(band, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_key", "bands"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def _salted(pairs: DataFrame) -> DataFrame:
    """Pairs with a salt for either side: about sqrt(n) / 4 of them for a row that is in n pairs, so one for most rows."""
    sized = with_group(pairs, ["a"], ["b"], {"in_a": F.count("*")})
    sized = with_group(sized, ["b"], ["a"], {"in_b": F.count("*")})
    salt = lambda by, n: F.pmod(F.xxhash64(by), F.ceil(F.sqrt(n) / 4))
    return sized.select("a", "b", salt("b", "in_a").alias("salt_a"), salt("a", "in_b").alias("salt_b"))


def _with_text(pairs: DataFrame, spread: DataFrame, texts: DataFrame, key: str, salt: str) -> DataFrame:
    """Pairs with the text of one side, which goes once to each salt of its row in spread."""
    there = spread.select(key, salt).distinct()
    side = texts.select(F.col("doc_id").alias(key), F.col("text").alias(f"text_{key}")).join(there, key)
    return pairs.join(side, [key, salt])


def _compared(pairs: DataFrame, texts: DataFrame, size: int, rest: bool = False) -> DataFrame:
    """a, b, common, n_a, n_b of pairs (a, b), counted on full shingle sets; with rest, the hashes of a's shingles that b lacks."""
    spread = stage(_salted(pairs), "spread")
    left = _with_text(spread, spread, texts, "a", "salt_a")
    both = _with_text(left, spread, texts, "b", "salt_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, set()
        for batch in batches:
            out = []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if tb != last:
                    last, held = tb, shingle_set(tb, size)
                own = shingle_set(ta, size)
                lacks = [xxhash.xxh64_intdigest(b" ".join(x)) - (1 << 63) for x in own - held] if rest else []
                out.append((len(own & held), len(own), len(held), lacks))
            common, na, nb, lacks = zip(*out) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in (common, na, nb)), pa.array(lacks, pa.list_(pa.int64()))],
                names=["a", "b", "common", "n_a", "n_b", "rest"],
            )

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, common long, n_a long, n_b long, rest array<long>")


def _similar(compared: DataFrame, per_cent: int) -> DataFrame:
    return compared.where(f"common > 0 AND 100 * common >= {per_cent} * (n_a + n_b - common)").select("a", "b")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, per_cent: int = PER_CENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs.

    A null text is empty; texts without words are linked with nothing. Rows that repeat a doc_id are one node of the graph,
    linked by any of its texts. A row without doc_id has a null component, links with nothing and is kept. Columns besides
    doc_id and text are not read; an empty table gives no rows.
    """
    signed = stage(signatures(docs, size, bands, rows), "signatures")
    usable = signed.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classed = with_group(usable, ["set_key", "n_shingles"], ["doc_id"], {"class": F.min("doc_id")})
    copies = classed.where("doc_id <> class").select(F.col("doc_id").alias("a"), F.col("class").alias("b")).distinct()
    each = classed.where("doc_id = class").dropDuplicates(["set_key", "n_shingles"]).select(F.col("class").alias("doc"), F.explode("bands").alias("bucket")).distinct()
    shared = stage(with_group(each, ["bucket"], ["doc"], {"n": F.count("*")}).where("n > 1"), "buckets")
    links = copies
    if not shared.isEmpty():
        texts = stage(docs.select("doc_id", "text").join(shared.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi"), "texts")
        links = copies.unionByName(_linked(shared, texts, size, per_cent))
    found = named(stars(links, "a", "b")).withColumnRenamed("node", "doc_id")
    whole = signed.join(found, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return whole.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _linked(shared: DataFrame, texts: DataFrame, size: int, per_cent: int) -> DataFrame:
    """Links (a, b) that connect all rows of a bucket that any chain of similar pairs in buckets connects: a row and the smallest of its component."""
    central = shared.groupBy("doc").agg(F.sum("n").alias("weight"))
    weighed = shared.select("bucket", "doc").join(central, "doc")
    best = F.max(F.struct("weight", (-F.col("doc")).alias("low")))
    # a bucket's reference need not be in it: the heaviest of the leads that its rows have in any bucket, so a large group has one
    own = with_group(weighed, ["bucket"], ["doc"], {"lead": best}).groupBy("doc").agg(F.max("lead").alias("own"))
    led = with_group(shared.select("bucket", "doc").join(own, "doc"), ["bucket"], ["doc"], {"lead": F.max("own")})
    led = stage(led.select("bucket", "doc", (-F.col("lead.low")).alias("lead")).where("doc <> lead"), "led")
    tests = stage(_compared(led.select(F.col("doc").alias("a"), F.col("lead").alias("b")).distinct(), texts, size, rest=True), "tests")
    edges = stars(_similar(tests, per_cent), "a", "b")
    tested = tests.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    # what each row shares with its lead; a doc_id of several texts may share anything, by its smallest text
    with_lead = tests.groupBy(F.col("a").alias("doc"), F.col("b").alias("lead")).agg(
        F.when(F.count("*") > 1, F.lit(ANY)).otherwise(F.max("common")).alias("common"), F.min("n_a").alias("n")
    )
    inside = join_spread(led, with_lead, ["doc", "lead"], ["bucket"], 8).select("bucket", "doc", "common", "n", F.lit(0).cast("long").alias("shared"))
    # of the shingles that the lead lacks those count that another row tested against it has
    lacks = tests.select(F.col("a").alias("doc"), F.col("b").alias("lead"), F.explode("rest").alias("s")).distinct()
    held = stage(with_group(lacks, ["lead", "s"], ["doc"], {"holders": F.count("*")}).where("holders > 1"), "held")
    counted = with_lead.join(held.groupBy("doc", "lead").agg(F.count("*").alias("shared")), ["doc", "lead"])
    outside = join_spread(held, counted, ["doc", "lead"], ["s"], 8).select(
        F.xxhash64("lead", "s").alias("bucket"), "doc", "common", "n", F.when(F.col("common") == ANY, F.lit(ANY)).otherwise(F.col("shared")).alias("shared")
    )
    # a row without room for per_cent of its own shingles is like no other
    state = stage(inside.unionByName(outside).where(100 * (F.col("common") + F.col("shared")) >= per_cent * F.col("n")), "state")
    room = lambda p: F.least("common", p["common"]) + F.least("shared", p["shared"])
    possible = lambda p: (p["component"] != F.col("component")) & ((100 + per_cent) * room(p) >= per_cent * (F.col("n") + p["n"]))
    # a row has at most one bucket a band, but maybe many buckets of shingles, which go to several lists
    share = F.when(F.col("shared") > 0, F.pmod("bucket", F.lit(SHARES))).otherwise(F.lit(0))
    block = BLOCK
    while True:
        found = named(edges).select(F.col("node").alias("doc"), "component")
        now = state.join(found, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        mixed = with_group(now, ["bucket"], ["doc"], {"lo": F.min("component"), "hi": F.max("component")})
        open_ = stage(mixed.where("lo <> hi").select("bucket", "doc", "component", "common", "n", "shared"), "open")
        size_of = open_.groupBy("bucket", "component").count()
        largest = size_of.groupBy("bucket").agg(F.max(F.struct("count", "component"))["component"].alias("largest"))
        minor = join_spread(open_, largest, ["bucket"], ["doc"]).where("component <> largest")
        order = Window.partitionBy("bucket").orderBy(F.xxhash64("doc", F.lit(block)), "doc")
        pivots = stage(minor.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= block + 1), "pivots")
        listed = pivots.where(F.col("rank") <= block).groupBy("bucket").agg(F.collect_list(F.struct("doc", "component", "common", "n", "shared")).alias("pivots"))
        met = join_spread(open_, listed, ["bucket"], ["doc"], 8).select("doc", share.alias("share"), F.transform(F.filter("pivots", possible), lambda p: p["doc"]).alias("pivots"))
        # a pair that shares several buckets becomes one row
        each = met.where(F.size("pivots") > 0).groupBy("doc", "share").agg(F.array_distinct(F.flatten(F.collect_list("pivots"))).alias("pivots"))
        cross = each.select("doc", F.explode("pivots").alias("pivot")).select(F.greatest("doc", "pivot").alias("a"), F.least("doc", "pivot").alias("b")).distinct()
        pairs = stage(cross.join(tested, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            similar = _similar(_compared(pairs, texts, size), per_cent)
            edges = stars(similar.unionByName(edges.select(F.col("u").alias("a"), F.col("v").alias("b"))), "a", "b")
        if pivots.where(F.col("rank") > block).isEmpty():
            return edges.select(F.col("u").alias("a"), F.col("v").alias("b"))
        tested = stage(tested.unionByName(pairs), "tested")
        block *= 32


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row of docs for each component, with all columns: that of the smallest doc_id. Rows without doc_id stay."""
    keep = near_duplicates(docs, size).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("held"), F.col("doc_id").cast("long").alias("id"))
    named = held.where("id IS NOT NULL").join(keep.withColumnRenamed("doc_id", "id"), "id", "left_semi").dropDuplicates(["id"])
    return named.unionByName(held.where("id IS NULL")).select("held.*")
