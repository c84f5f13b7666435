"""Quality by a regularised quadratic discriminant over transformed document statistics.

Counts of bytes, words and lines give a few bounded or logarithmic statistics. Class means and covariances are summed by
Spark over all labelled rows, covariances shrunk to their diagonal and to each other; Cholesky factors are taken once, and a
text's score is the logistic of the difference of the two log-densities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import stage

SHRINK_DIAGONAL = 0.1
SHRINK_POOLED = 0.05
FLOOR = 1e-4
STATISTICS = (
    "log_words", "word_length", "upper", "digits", "signs", "bars", "exclaims", "distinct_words", "top_word", "repeats", "ended_words", "doubled_signs",
)
_KIND = np.zeros(256, np.uint8)  # 1 upper, 2 digit, 3 sign, 4 bar, 5 exclamation mark, 6 white space
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3
_KIND[[ord(c) for c in ".,;:'-"]] = 0
_KIND[65:91], _KIND[48:58], _KIND[ord("|")], _KIND[ord("!")] = 1, 2, 4, 5
_KIND[[32, 9, 10, 11, 12, 13]] = 6


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text; an empty or null one has all of them 0."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(data, np.uint8)
    kinds = _KIND[raw]
    n, w = np.bincount(kinds, minlength=7), len(words)
    ink = max(len(raw) - n[6], 1)
    counts: dict[bytes, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    same = sum(a == b for a, b in zip(words, words[1:]))
    signs = kinds == 3
    doubled = int((signs[1:] & signs[:-1]).sum()) + int(((kinds[1:] == 5) & (kinds[:-1] == 5)).sum())
    shares = (n[1] / ink, n[2] / ink, n[3] / ink, n[4] / w, n[5] / w)
    return [
        np.log1p(w) / 5,
        np.log(ink / w),
        *(np.sqrt(s) for s in shares),
        np.log(len(counts) / w) / (1 + np.log(w)),
        np.sqrt(max(counts.values()) / w),
        np.sqrt(same / w),
        np.sqrt(len([1 for x in words if x[-1] in b".,;:!?"]) / w),
        np.sqrt(min(doubled / w, 1.0)),
    ]


@dataclass
class Discriminant:
    """Means, cached Cholesky factors and log-determinants of the classes, and the log of their prior odds."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of class 1 of each row of x."""
        if not self.means:
            return np.full(len(x), 1 / (1 + np.exp(-self.log_odds)))
        dens = []
        for mean, factor in zip(self.means, self.factors):
            z = np.linalg.solve(factor, (x - mean).T)
            dens.append(-0.5 * (z**2).sum(0) - np.log(np.diag(factor)).sum())
        return 1 / (1 + np.exp(-np.clip(dens[1] - dens[0] + self.log_odds, -500, 500)))


def discriminant(n: list[float], sums: list[np.ndarray], squares: list[np.ndarray]) -> Discriminant:
    """From each class's rows, sums and sums of outer products. With a class of under two rows only prior odds count."""
    log_odds = float(np.log((n[1] + 0.5) / (n[0] + 0.5)))
    if min(n) < 2:
        return Discriminant([], [], log_odds)
    means = [s / k for s, k in zip(sums, n)]
    covs = [q / k - np.outer(m, m) for q, k, m in zip(squares, n, means)]
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / sum(n)
    factors = []
    for cov in covs:
        mixed = (1 - SHRINK_POOLED) * cov + SHRINK_POOLED * pooled
        shrunk = (1 - SHRINK_DIAGONAL) * mixed + SHRINK_DIAGONAL * np.diag(np.diag(mixed))
        factors.append(np.linalg.cholesky(shrunk + FLOOR * np.eye(len(cov))))
    return Discriminant(means, factors, log_odds)


def is_held_out():
    """Rows that teach nothing: crc32 of the doc_id as text, modulo 5, is 0. A null doc_id is held out, too."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and its text's statistics x, staged: all else goes by these few numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stage(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<double>"), "statistics")


def fit(rows: DataFrame, labels: DataFrame) -> Discriminant:
    """From all labelled rows of measured() outside the held-out fifth; a doc_id whose labels are null or contradict one another is left out."""
    clean = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    taught = rows.join(clean.where((F.col("quality") == F.col("most")) & ~is_held_out()).select("doc_id", "quality"), "doc_id")
    d = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            x, label = flat.reshape(-1, d), batch.column(1).to_numpy(zero_copy_only=False)
            for k in (0, 1):
                own = x[label == k]
                n[k] += len(own)
                s[k] += own.sum(0)
                q[k] += own.T @ own
        yield pa.RecordBatch.from_pydict({"n": n.tolist(), "s": s.tolist(), "q": q.reshape(2, -1).tolist(), "label": pa.array([0, 1], pa.int32())})

    sums = taught.select("x", "quality").mapInArrow(run, "n double, s array<double>, q array<double>, label int")
    flat = sums.select("label", F.posexplode(F.concat(F.array("n"), "s", "q")).alias("at", "x"))
    total = np.zeros((2, 1 + d + d * d))
    for r in flat.groupBy("label", "at").agg(F.sum("x").alias("x")).collect():  # 2 * (1 + d + d * d) numbers
        total[r["label"], r["at"]] = r["x"]
    return discriminant(list(total[:, 0]), list(total[:, 1 : 1 + d]), [t.reshape(d, d) for t in total[:, 1 + d :]])


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    A null or empty text has all statistics 0 and is scored by them. Repeated rows get equal scores; an empty table gives no rows;
    with labels of one class only every score is the share of the label.
    """
    rows = measured(docs)
    shared = docs.sparkSession.sparkContext.broadcast(fit(rows, labels))  # two means and factors of a dozen columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x), pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
