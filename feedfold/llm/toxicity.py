"""Toxicity by subword-bag embeddings under a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams (hashed to a fixed number of rows), a window of words the mean of
its words, and a softmax over two classes scores the window. A text is as toxic as its most toxic window: a few words
in a long text count as they would in a short one. A toxic text teaches by the window whose n-grams occur most in
*other* toxic texts (its own do not count, else chance words of one text are learnt); a clean text by the window that
the model thinks most toxic at the time. Misspelt words share n-grams with the words they stand for; a share DROPPED of
n-grams is left out at each step of training, so that a part of a word's n-grams suffices.

Training takes at most SAMPLE_ROWS labelled rows, by hash order, in one task, so that the driver holds neither these texts nor what
training needs (some 300 MB). As all above the n-gram vectors is linear, the model comes
down to one number per n-gram row, which is what scoring sends to the executors (a fixed size).
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# WINDOW, NOISE and DROPPED were chosen by the log loss on a part of sf0.1's training rows that was held back from training.
SAMPLE_ROWS = 6000
ROWS = 1 << 17
DIM = 8
WINDOW = 4
NOISE = 0.2
DROPPED = 0.75
CACHE_WORDS = 200_000  # about 32 MB
#: Fixed: what separates and what trims words.
EDGES = " \t\n\x0b\x0c\r.,;:!?\"'()[]{}<>|*#$%&@~`^_+=-/\\"
_EDGE = re.compile(f"[{re.escape(EDGES)}]+")
PIECE, LONGEST_GRAM = 64, 6


def pieces(run: str) -> list[str]:
    """A run of more than PIECE characters: cut at EDGES, what is still longer into pieces that overlap, so that no n-gram is lost."""
    step = PIECE - LONGEST_GRAM + 1
    parts = [p for p in _EDGE.split(run) if p]
    return [p[at : at + PIECE] for p in parts for at in range(0, max(1, len(p) - LONGEST_GRAM + 1), step)] or [run[:1]]


def words_of(text: str) -> list[str]:
    """What white space separates; a long run (no spaces, or words joined by other signs) counts as several words."""
    out: list[str] = []
    for w in text.lower().split():
        if len(w) > PIECE:
            out += pieces(w)
        else:
            out.append(w)
    return out


def ngrams(word: str) -> list[int]:
    """Hashed rows of the character 3- to 6-grams of a word between < and >, and of the word itself."""
    core = f"<{word.strip(EDGES)}>"
    data = [core[i : i + n] for n in range(3, LONGEST_GRAM + 1) for i in range(len(core) - n + 1)]
    return [zlib.crc32(g.encode("utf-8", "replace")) % ROWS for g in (*data, f"{core} ")]


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()


def gram_rows(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """ngrams() of many words at once: all their rows, word after word, and how many each word has."""
    cores = [f"<{w.strip(EDGES)}>" for w in words]
    raw = np.frombuffer("".join(cores).encode("utf-8", "replace"), np.uint8)
    at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # where each character starts
    sizes = np.fromiter(map(len, cores), np.int64, len(cores))
    first = np.cumsum(sizes) - sizes
    rows, whose = [], []
    for n in range(3, LONGEST_GRAM + 1):
        count = np.maximum(sizes - n + 1, 0)
        word = np.repeat(np.arange(len(cores)), count)
        start = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count) + first[word]
        low, size = at[start], at[start + n] - at[start]
        crc = np.full(len(word), 0xFFFFFFFF, np.uint32)
        for k in range(int(size.max(initial=0))):
            some = slice(None) if k < n else np.flatnonzero(size > k)  # n characters are n bytes or more
            crc[some] = _CRC[(crc[some] ^ raw[low[some] + k]) & 255] ^ (crc[some] >> 8)
        rows.append((~crc).astype(np.int64) % ROWS)
        whose.append(word)
    rows.append(np.fromiter((zlib.crc32(f"{c} ".encode("utf-8", "replace")) % ROWS for c in cores), np.int64, len(cores)))
    whose.append(np.arange(len(cores)))
    word = np.concatenate(whose)
    return np.concatenate(rows)[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(cores))


@dataclass
class Model:
    """One number per n-gram row, and the softmax's bias: the log-odds of a window is their mean over words plus bias."""

    weights: np.ndarray
    bias: float

    def learn_words(self, words: Iterable[str], cache: dict[str, float]) -> None:
        """Scores of words that the cache lacks; a cache that is full is emptied first."""
        wanted = set(words)
        new = list(wanted.difference(cache))
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = list(wanted)
        for at in range(0, len(new), 16384):
            part = new[at : at + 16384]
            rows, sizes = gram_rows(part)
            cache.update(zip(part, (np.add.reduceat(self.weights[rows].astype(float), np.cumsum(sizes) - sizes) / sizes).tolist()))

    def score(self, text: str | None, cache: dict[str, float]) -> float:
        return self.scores([text], cache)[0]

    def scores(self, texts: Sequence[str | None], cache: dict[str, float]) -> list[float]:
        """Of each text the score of its most toxic window. The words of all texts at hand are scored together."""
        split = [words_of(t or "") for t in texts]
        self.learn_words(itertools.chain.from_iterable(split), cache)
        out = []
        for words in split:
            if not words:
                out.append(float(1 / (1 + np.exp(-self.bias))))
                continue
            s = np.fromiter(map(cache.__getitem__, words), float, len(words))
            n = min(WINDOW, len(s))
            run = np.concatenate(([0.0], np.cumsum(s)))
            best = ((run[n:] - run[:-n]) / n).max() + self.bias
            out.append(float(1 / (1 + np.exp(-np.clip(best, -30, 30)))))
        return out


def _windows(of_gram, flat, ends, sizes, docs, noise=None) -> np.ndarray:
    """Where in its text the best window of each text starts, given a number for each n-gram; noise(n) is added to windows."""
    per_word = np.empty(len(sizes))
    for at in range(0, len(sizes), 16384):  # some words' n-grams at a time
        to = min(at + 16384, len(sizes))
        per_word[at:to] = np.add.reduceat(of_gram[flat[ends[at] : ends[to]]], ends[at:to] - ends[at]) / sizes[at:to]
    best = []
    for at in range(0, len(docs), 256):
        part = docs[at : at + 256]
        run = np.concatenate(([0.0], np.cumsum(per_word[np.concatenate(part)])))
        means = run[np.minimum(np.arange(len(run) - 1) + WINDOW, len(run) - 1)] - run[:-1]
        if noise:
            means += noise(len(means))
        start = 0
        for m in map(len, part):
            best.append(int(np.argmax(means[start : start + m - WINDOW + 1])) if m > WINDOW else 0)
            start += m
    return np.array(best)


def train(texts: Iterable[str], labels: list[int], epochs: int = 30, rate: float = 0.3, seed: int = 7) -> Model:
    """Embeddings and softmax trained together by Adagrad, each text by its currently most toxic window."""
    if len(set(labels)) < 2:
        return Model(np.zeros(ROWS, np.float32), 4.0 if labels and labels[0] else -4.0)
    index: dict[str, int] = {}
    docs, y = [], []
    for t, lab in zip(texts, labels):
        ids = [index.setdefault(w, len(index)) for w in words_of(t)]
        if ids:
            docs.append(np.array(ids, np.int32))
            y.append(float(lab))
    known = list(index)
    del index
    parts, counts = [], []
    for at in range(0, len(known), 16384):
        rows, own = gram_rows(known[at : at + 16384])
        parts.append(rows.astype(np.int32))
        counts.append(own)
    del known
    flat, ends = np.concatenate(parts), np.concatenate(([0], np.cumsum(np.concatenate(counts))))
    del parts
    place = np.zeros(ROWS, np.int32)
    place[flat] = 1
    used = np.flatnonzero(place)
    place[used] = np.arange(len(used), dtype=np.int32)
    flat = place[flat]
    sizes = np.diff(ends)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (len(used), DIM))
    soft = rng.normal(0, 0.5, (DIM, 2))
    bias = np.array([2.0, 0.0])
    g_emb, g_soft, g_bias = np.full(len(used), 1e-4), np.full((DIM, 2), 1e-2), np.full(2, 1e-2)
    lens = np.array([len(d) for d in docs])
    y = np.array(y)
    df0, df1 = df = np.zeros((2, len(used)), np.int64)
    for d, lab in zip(docs, y):
        df[int(lab), np.unique(np.concatenate([flat[ends[w] : ends[w + 1]] for w in np.unique(d)]))] += 1
    prior = y.mean()
    rate_of = (np.maximum(df1 - 1, 0) + prior) / (np.maximum(df1 - 1, 0) + df0 + 1)
    odds = np.log(rate_of / (1 - rate_of)) - np.log(prior / (1 - prior))
    balance = np.where(y == 1, (len(y) - y.sum()) / y.sum(), 1.0) ** 0.5
    n = np.minimum(WINDOW, lens)
    for epoch in range(epochs):
        # with noise, so that all toxic words of a text get their turn
        fixed = _windows(odds, flat, ends, sizes, docs, lambda m: rng.gumbel(0, NOISE, m))
        chosen = _windows(emb @ (soft[:, 1] - soft[:, 0]), flat, ends, sizes, docs) if epoch else fixed
        pick = np.where(y == 1, fixed, chosen)
        for part in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // 64)):
            picked = [docs[i][pick[i] : pick[i] + n[i]] for i in part]
            words = np.concatenate(picked)
            whose = np.repeat(np.arange(len(part)), [len(p) for p in picked])
            share = 1 / np.array([len(p) for p in picked])[whose]
            spans = [flat[ends[w] : ends[w + 1]] for w in words]
            g_ids = np.concatenate(spans)
            counts = np.array([len(s) for s in spans])
            g_whose = np.repeat(whose, counts)
            g_share = np.repeat(share / counts, counts) * (rng.random(len(g_ids)) >= DROPPED)
            hidden = np.zeros((len(part), DIM))
            np.add.at(hidden, g_whose, emb[g_ids] * g_share[:, None])
            z = hidden @ soft + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            err = (p - np.stack([1 - y[part], y[part]], 1)) * balance[part][:, None]
            d_soft, d_bias, d_hidden = hidden.T @ err, err.sum(0), err @ soft.T
            touched, where = np.unique(g_ids, return_inverse=True)
            d_emb = np.zeros((len(touched), DIM))
            np.add.at(d_emb, where, d_hidden[g_whose] * g_share[:, None])
            g_emb[touched] += (d_emb**2).mean(1)
            emb[touched] -= rate * d_emb / np.sqrt(g_emb[touched])[:, None]
            g_soft += d_soft**2
            soft -= rate * d_soft / np.sqrt(g_soft)
            g_bias += d_bias**2
            bias -= rate * 0.3 * d_bias / np.sqrt(g_bias)
    weights = np.zeros(ROWS, np.float32)
    weights[used] = emb @ (soft[:, 1] - soft[:, 0])
    return Model(weights, float(bias[1] - bias[0]))


def is_held_out(doc_id: str = "doc_id"):
    """Rows that teach nothing: crc32 of the doc_id as text, modulo 3, is 1. A null doc_id is held out, too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model of labels.toxic from at most sample_rows labelled rows outside the held-out third.

    Rows are taken in the order of a hash of their id. Labels that are null, or contradict one another for a doc_id, are not used.
    """
    clean = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    taught = clean.where((F.col("toxic") == F.col("most")) & ~is_held_out()).select("doc_id", "toxic")
    chosen = taught.orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(sample_rows)
    order = [F.xxhash64("doc_id", F.lit(17)), F.col("doc_id"), F.col("text")]
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").orderBy(*order).limit(sample_rows).coalesce(1).sortWithinPartitions(*order)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        model = train((t.as_py() or "" for b in held for t in b.column(0)), [y for b in held for y in b.column(1).to_pylist()])
        del held
        pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias], pa.float64())], names=["weights", "bias"])

    found = rows.select("text", "toxic").mapInArrow(learn, "weights binary, bias double").first()
    return Model(np.frombuffer(found["weights"], np.float32), found["bias"]) if found else train([], [])


def score_texts(docs: DataFrame, model: Model, keep: Sequence[Column]) -> DataFrame:
    """The given columns of docs and `score`, the toxicity of each whole text, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    rows = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = Model(*shared.value), {}
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            scores = [x for at in range(0, len(texts), 128) for x in own.scores(texts.slice(at, 128).to_pylist(), cache)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "score"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    A null or empty text has no window and gets the score of the bias alone. Repeated rows get equal scores; an empty table gives
    no rows, and without usable labels every score is the same low one.
    """
    scored = score_texts(docs, fit(docs, labels, sample_rows), [F.col("doc_id")])
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs whose score is under the threshold, with their own columns."""
    held = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("held")
    return score_texts(docs, fit(docs, labels, sample_rows), [held]).where(F.col("score") < threshold).select("held.*")
