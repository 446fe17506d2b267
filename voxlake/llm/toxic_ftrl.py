"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of letters, digits and underscores of the lower-cased text. Features are the distinct hashes, in
``BUCKETS``, of words, of pairs of neighbours and of pairs with one word between them, and, as inflected forms
of a rare word share their beginning, of the first ``STEMS`` letters of longer words. The learner goes
through the labelled rows one by one: each coordinate has its own rate (``ALPHA / (BETA + sqrt(sum of squared
gradients))``), and the L1 term keeps a weight at zero until its evidence exceeds it, so what is left is a
short list of buckets with weights. Rows of the rarer label weigh the square root of the other's number over
theirs. The list is broadcast; scoring looks a batch's hashes up in it.

Fit: at most about ``SAMPLE`` labelled rows, drawn by a hash of the id, all if there are fewer. Their ids
are bounded by that, so they are broadcast to the scan of the texts; features come from the tasks, and one
task learns from them in ``EPOCHS`` passes, rows in order of their hash, so equal input gives equal weights.
Scoring goes over all rows and whole texts, in slices.

Defined cases: an empty, blank or null text has the score of the bias alone; without a labelled row of each
label every score is 0; a null label is none, of several labels of an id the largest counts; repeated rows are
scored alike, and a row without an id is never learned from; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm.bpe_scan import in_slices
from voxlake.llm.common import python_ready, written

BITS = 20
BUCKETS = 1 << BITS
SAMPLE = 20_000         # about the most labelled rows that the fit sees
DRAWS = 1_000_000       # steps of the share that is drawn
EPOCHS = 4
ALPHA, BETA, L1 = 0.3, 1.0, 10.0
CHARS = 400_000         # characters at once
STEMS = (5, 6)
BASE = 0x9E3779B97F4A7C15       # odd, so it has an inverse modulo 2^64


@lru_cache(1)
def word_points() -> np.ndarray:
    """Per code point: does it belong to a word (a letter, a digit or an underscore)?"""
    return np.fromiter((chr(c).isalnum() or c == 95 for c in range(0x110000)), bool, 0x110000)


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, from 0 to n - 1."""
    up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def word_hashes(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hash of every word, then of its stems (0 where it is no longer than the stem), and the index of its text.

    The hash of a run is the sum of its code points times powers of BASE from its first one on: a difference of
    running sums, times the inverse power of its start, so no word is touched alone."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = word_points()[points]
    start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    up, down = _powers(1 << (len(points) - 1).bit_length())
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], dtype=np.uint64, out=sums[1:])
    back = down[start]
    out = [(sums[end] - sums[start]) * back]
    for n in STEMS:
        out.append(np.where(end - start > n, (sums[np.minimum(start + n, len(points))] - sums[start]) * back, 0))
    first = np.cumsum([1, *(len(t) + 1 for t in lowered)])
    return out, np.searchsorted(first, start, "right") - 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - BITS)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word, stem, neighbour pair and skip pair, and the index of its text (with repeats)."""
    (h, *stems), of = word_hashes(texts)
    out, owner = [_mixed(h)], [of]
    for k, stem in enumerate(stems, 1):
        longer = np.flatnonzero(stem)
        out.append(_mixed(stem[longer] + np.uint64(k)))
        owner.append(of[longer])
    for gap, salt in ((1, 0xD1B54A32D192ED03), (2, 0xAEF17502108EF2D9)):
        same = np.flatnonzero(of[gap:] == of[:-gap])
        out.append(_mixed(h[same] + h[same + gap] * np.uint64(salt)))
        owner.append(of[same])
    return np.concatenate(out).astype(np.int64), np.concatenate(owner)


@dataclass
class Model:
    bias: float | None      # None: no model
    buckets: np.ndarray     # ascending
    weights: np.ndarray


class Ftrl:
    """The learner: per coordinate the sums z and n; the weight follows from them."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)       # the last is the bias

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == BUCKETS, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA))

    def learn(self, at: np.ndarray, label: float, weight: float = 1.0) -> None:
        """One row with the distinct coordinates ``at`` (the bias among them)."""
        w = self.weights(at)
        g = weight * (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label)
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g

    def model(self) -> Model:
        w = self.weights(np.arange(BUCKETS + 1))
        at = np.flatnonzero(w[:BUCKETS])
        return Model(float(w[BUCKETS]), at, w[at])


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The model of the labelled rows of which ``may_learn``, a column of the labels, holds."""
    python_ready(docs.sparkSession)
    known = labels.where(may_learn).where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(label).alias("y"))
    known = written(known.withColumn("draw", F.xxhash64("k")), "toxic-labels")
    n = known.count()
    share = min(DRAWS, DRAWS * SAMPLE // max(n, 1))
    drawn = known.where(F.pmod("draw", F.lit(DRAWS)) < share)
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(drawn), "k").select("draw", "k", "y", "t")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).to_pylist()
            for a, some in in_slices(texts, CHARS):
                cell = np.unique(np.add(*[x * k for x, k in zip(grams(some)[::-1], (BUCKETS, 1))]))
                cut = np.searchsorted(cell, np.arange(len(some) + 1) * BUCKETS)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(some)), batch.column(2).slice(a, len(some)).cast(pa.float64()),
                                                  pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(cell % BUCKETS, pa.int32()))], names=["draw", "y", "at"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [(np.append(at, BUCKETS), float(y > 0)) for b in batches for y, at in zip(b.column(1).to_pylist(), (x.values.to_numpy() for x in b.column(2)))]
        share = sum(y for _, y in seen) / max(len(seen), 1)
        if 0 < share < 1:
            weight = {1.0: max(1.0, (1 / share - 1) ** 0.5), 0.0: max(1.0, (1 / (1 - share) - 1) ** 0.5)}
            learner = Ftrl()
            for _ in range(EPOCHS):
                for at, y in seen:
                    learner.learn(at, y, weight[y])
            m = learner.model()
            yield pa.RecordBatch.from_arrays([pa.array(np.append(m.buckets, -1)), pa.array(np.append(m.weights, m.bias))], names=["at", "w"])

    made = written(rows.mapInArrow(features, "draw long, y double, at array<int>"), "toxic-rows")
    one = made.repartition(1).sortWithinPartitions("draw", "y", F.xxhash64("at")).mapInArrow(learn, "at long, w double")
    found = one.limit(BUCKETS + 1).toArrow()       # one row for each weight that is not zero
    at, w = found.column("at").to_numpy(), found.column("w").to_numpy()
    if not len(at):
        return Model(None, np.empty(0, np.int64), np.empty(0))
    return Model(float(w[at < 0][0]), at[at >= 0], w[at >= 0])


def scores(texts: list[str], model: Model, weight: np.ndarray) -> np.ndarray:
    """``weight`` holds the model's weights by bucket."""
    if model.bias is None:
        return np.zeros(len(texts))
    bucket, of = grams(texts)
    hit = np.flatnonzero(weight[bucket])
    cell = np.unique(of[hit] * np.int64(BUCKETS) + bucket[hit])     # a feature counts once for a text
    total = model.bias + np.bincount(cell // BUCKETS, weight[cell % BUCKETS], len(texts))
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, predicted`` for every row."""
    python_ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(BUCKETS)
        weight[sent.value.buckets] = sent.value.weights
        for batch in batches:
            for a, some in in_slices([t or "" for t in batch.column(1).to_pylist()], CHARS):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(some)), pa.array(scores(some, sent.value, weight))], names=["k", "score"])

    out = d.mapInArrow(run, f"k {dict(d.dtypes)['k']}, score double")
    return out.select(F.col("k").alias(key), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))


def held_out(key: str = "doc_id") -> Column:
    """Rows that the fit leaves out: 5 divides the crc32 of the id as text (a null id: not)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))
