"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased and every run of other characters counts as one blank; the n-grams of one to
``ORDER`` characters (not the blank alone) are hashed into ``BUCKETS``. Training counts buckets per
language over all rows it is given, in numpy, one sparse row per task, language and bucket; the sums
form the matrix of log probabilities (Laplace smoothing ``ALPHA``), whose size is ``languages x BUCKETS``
floats, at most ``MAX_LANGUAGES`` languages (more raise). It is broadcast; scoring counts a batch's
buckets and multiplies the non-zero ones, so nothing of a text's length is dense.

``score`` is the posterior of the chosen language; ``margin`` is the lead over the second per n-gram.
Only the text enters a prediction.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is every text if no
labelled row exists; ties go to the language first in order; repeated rows are judged alike; an empty
table gives an empty table; rows with a null language are not learned from; other columns of the input
are ignored (``predict``) or kept (``known``).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlake.llm.bpe_scan import in_slices
from voxlake.llm.common import python_ready

ORDER = 3
BITS = 14
BUCKETS = 1 << BITS
ALPHA = 0.5
MAX_LANGUAGES = 200
CELLS = 1 << 22         # counters at once in scoring
CHARS = 500_000         # characters at once
UNKNOWN = "und"


@lru_cache(1)
def letters() -> np.ndarray:
    """Per code point: itself if it is a letter, else the blank."""
    table = np.fromiter((c if unicodedata.category(chr(c))[0] == "L" else 32 for c in range(0x110000)), np.uint32, 0x110000)
    return table


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram, and the index of its text (in no fixed order)."""
    joined = " " + " ".join(texts).lower() + " "
    # Lower-casing may change a text's length, so places are found from the lower-cased parts.
    sizes = np.fromiter((len(t.lower()) + 1 for t in texts), np.int64, len(texts))
    points = letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if len(points) != sizes.sum() + 1:      # a letter whose lower case depends on its neighbours
        points = letters()[np.frombuffer((" " + " ".join(t.lower() for t in texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)]
    text = np.repeat(np.arange(len(texts)), sizes)
    text = np.append(text, len(texts) - 1)
    blank = points == 32
    keep = ~(blank[1:] & blank[:-1])        # one blank for each run, inside texts and between them
    keep = np.append(True, keep)
    points, text, blank = points[keep].astype(np.uint64), text[keep], blank[keep]
    out, of = [], []
    h = points * np.uint64(0x9E3779B97F4A7C15)
    for n in range(1, ORDER + 1):
        if n > 1:
            h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + points[n - 1 :] * np.uint64(0x9E3779B97F4A7C15)
        mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        bucket = (mixed >> np.uint64(64 - BITS)).astype(np.int64)
        # An n-gram belongs to the text of its last character but one blank may close it.
        if n == 1:
            use = ~blank
        else:
            use = ~blank[1 : len(h) + 1] if n == 3 else ~(blank[: len(h)] & blank[1 : len(h) + 1])
        out.append(bucket[use])
        of.append(text[(1 if n == 3 else 0) : len(h) + (1 if n == 3 else 0)][use] if n != 2 else
                  np.where(blank[: len(h)], text[1 : len(h) + 1], text[: len(h)])[use])
    return np.concatenate(out), np.concatenate(of)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray       # log, by language
    matrix: np.ndarray      # log probabilities, buckets x languages


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model of all rows with a language."""
    python_ready(labelled.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, some in in_slices(texts, CHARS):
                names = sorted(set(langs[a : a + len(some)]))
                code = {n: i for i, n in enumerate(names)}
                own = np.array([code[n] for n in langs[a : a + len(some)]], np.int64)
                bucket, of = grams(some)
                found = np.bincount(own[of] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                for n, row, held in zip(names, found, np.bincount(own, minlength=len(names)).tolist()):
                    counts[n] = counts.get(n, 0) + row
                    docs[n] = docs.get(n, 0) + held
        for n, row in counts.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([n] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1)),
                                              pa.array(np.append(row[at], docs[n]))], names=["lang", "bucket", "n"])

    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("l"), F.col(text).alias("t"))
    sums = rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.limit((MAX_LANGUAGES + 1) * (BUCKETS + 1)).toArrow()       # bounded: raises below if there are more
    names, code = np.unique(np.array(found.column("lang").to_pylist() or [""], object), return_inverse=True)
    if not len(found):
        return Model([], np.empty(0), np.empty((BUCKETS, 0)))
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    bucket, n = found.column("bucket").to_numpy(), found.column("n").to_numpy()
    matrix = np.zeros((BUCKETS, len(names)))
    matrix[bucket[bucket >= 0], code[bucket >= 0]] = n[bucket >= 0]
    docs = np.zeros(len(names))
    docs[code[bucket < 0]] = n[bucket < 0]
    matrix = np.log((matrix + ALPHA) / (matrix.sum(axis=0) + ALPHA * BUCKETS))
    return Model([str(x) for x in names], np.log(docs / docs.sum()), matrix)


def scores(texts: list[str], model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, posterior and margin per n-gram of each text."""
    total = np.zeros((len(texts), len(model.languages)))
    size = np.zeros(len(texts))
    step = max(1, CELLS // BUCKETS)
    for a in range(0, len(texts), step):
        some = texts[a : a + step]
        bucket, of = grams(some)
        cells = np.bincount(of * BUCKETS + bucket, minlength=len(some) * BUCKETS)
        at = np.flatnonzero(cells)
        n, doc = cells[at].astype(float), at // BUCKETS
        starts = np.flatnonzero(np.diff(doc, prepend=-1))
        if len(starts):
            total[a + doc[starts]] = np.add.reduceat(n[:, None] * model.matrix[at % BUCKETS], starts, axis=0)
            size[a + doc[starts]] = np.add.reduceat(n, starts)
    total += model.prior
    best = total.argmax(axis=1)
    top = total[np.arange(len(texts)), best]
    posterior = 1 / np.exp(total - top[:, None]).sum(axis=1)
    others = total.copy()
    others[np.arange(len(texts)), best] = -np.inf
    second = others.max(axis=1) if len(model.languages) > 1 else np.full(len(texts), -np.inf)
    margin = np.where(np.isfinite(second), top - second, 0.0) / np.maximum(size, 1)
    known = np.array([has_letter(t) for t in texts], bool)
    names = [model.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
    return names, np.where(known, posterior, 0.0), np.where(known, margin, 0.0)


def _scored(d: DataFrame, model: Model) -> DataFrame:
    """``d`` is ``(r, t)``: any column and the text. Adds lang_pred, score, margin; drops t."""
    python_ready(d.sparkSession)
    sent = d.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = sent.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, some in in_slices(texts, CHARS):
                names, score, margin = scores(some, m) if m.languages else ([UNKNOWN] * len(some), np.zeros(len(some)), np.zeros(len(some)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(some)), pa.array(names, pa.string()),
                                                  pa.array(score), pa.array(margin)], names=["r", "lang_pred", "score", "margin"])

    schema = T.StructType([d.schema["r"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("margin", T.DoubleType())])
    return d.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score, margin`` for every row."""
    d = docs.select(F.col(key).alias("r"), F.col(text).alias("t"))
    return _scored(d, model).withColumnRenamed("r", key)


def held_out(key: str = "doc_id"):
    """Rows that training leaves out: crc32 of the id as text is 1 modulo 3 (a null id is not)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def known(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is recognised with a posterior of at least ``least``; ``lang``
    holds the recognised language."""
    cols = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("r"), F.col(text).alias("t"))
    out = _scored(d, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return out.select(*[F.col("lang_pred").alias(c) if c == lang else F.col(f"r.`{c}`") for c in cols])
