r"""Spelling variants: blocked Gram matrices of letter counts, verified edits, and the form each variant leads to.

Words are counted in JVM expressions over whole texts. Two words are near if one inserted, deleted or replaced
code point makes them equal. Such a pair has lengths that are equal or neighbours, and the squared distance of its
letter-count vectors is at most two. Comparing whole length blocks would grow with the square of the vocabulary,
so length blocks are cut further, without loss: for a length ``b`` the word is divided into pieces of about
``PIECE`` letters, and a key is the word without one piece (its hole). Words of length ``b`` and, with one
letter more in the hole, of length ``b + 1`` meet under the same key; an edit lies in one hole, and all other
letters agree. So each word has a key for every hole of its own length block and of the one below.

Keys are dealt by hash and sorted, and a task goes through its keys in batches: groups are packed into tiles of
``TILE`` rows, the tile's count matrix times its transpose gives all squared distances, pairs of one group at most
two apart are kept and their edits verified on code points. A pair counts only in the hole that holds its first
difference, so it is found exactly once and needs no distinct. A group larger than a tile is multiplied tile by
tile. Words that share all but one hole of two letters bound a group, whatever the corpus; words of more than
``PIECE * HOLES`` letters have ``HOLES`` longer holes, so that keys stay linear in a word's length.

A word's form is its near word of largest count (ties: smallest in code-point order) if that count is at least
``TIMES`` its own. Counts grow by that factor along forms, so chains are short and have no cycle; pointer doubling
finds their ends.

Defined cases: null and empty texts have no words; a null id counts as an empty text in the id's place; repeated
rows count again, as their words occur again; very long words are handled like others, compared one pair at a
time; a table without words gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import lower_az, python_ready, written

# Fixed values of the contract.
RUN = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT = 7, 2
ONE_IN = 31             # runs that lose a code point: this divides their hash
TIMES = 10

LETTERS = 26 + 64       # a-z and the code points C0 to FF
PIECE, HOLES = 2, 32
TILE = 384
WIDTH = 64              # longest word that is compared in a matrix
ROWS = 40_000           # rows at once


def words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: the words of all texts that are long and frequent enough."""
    pattern = f"{RUN}{{{LEAST_LENGTH},}}+"
    d = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).alias("t"))
    # An outer explode, as an inner one would search each text twice (a filter on the list's size at the scan).
    runs = d.select("id", F.explode_outer(F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).alias("run")).where("run IS NOT NULL")
    runs = runs.select("id", lower_az(F.col("run")).alias("w"))
    runs = runs.select("w", F.crc32(F.concat_ws(":", "id", "w").cast("binary")).alias("h"))
    cut = F.expr("concat(substring(w, 1, cast(h % length(w) as int)), substring(w, cast(h % length(w) as int) + 2))")
    found = runs.select(F.when(F.col("h") % ONE_IN == 0, cut).otherwise(F.col("w")).alias("word")).where(f"length(word) >= {LEAST_LENGTH}")
    return found.groupBy("word").agg(F.count("*").alias("n")).where(f"n >= {LEAST_COUNT}")


def holes(b: int) -> int:
    """Number of pieces of a word of ``b`` letters."""
    return min(-(-b // PIECE), HOLES)


def keys(counted: DataFrame) -> DataFrame:
    """``key, hole, base, word, n``: every word under each hole of its length block and of the one below."""
    d = counted.select("word", "n", F.length("word").alias("len"), F.expr("explode(array(0, 1))").alias("more"))
    d = d.withColumn("base", F.col("len") - F.col("more")).where(f"base >= {LEAST_LENGTH}")
    d = d.withColumn("k", F.least(F.ceil(F.col("base") / PIECE).cast("int"), F.lit(HOLES)))
    d = d.select("*", F.expr("explode(sequence(0, k - 1))").alias("hole"))
    d = d.withColumn("a", F.expr("cast(hole * base div k as int)")).withColumn("z", F.expr("cast((hole + 1) * base div k as int)"))
    return d.select(F.expr("xxhash64(base, hole, substring(word, 1, a), substring(word, z + more + 1))").alias("key"), "hole", "base", "word", "n")


@lru_cache(1)
def _letter() -> np.ndarray:
    """Number of each letter from 1, in code-point order."""
    out = np.zeros(256, np.uint8)
    out[97:123] = np.arange(1, 27)
    out[0xC0:] = np.arange(27, 27 + 64)
    return out


def edited(x: str, y: str) -> int:
    """First place where the shorter ``x`` and ``y`` differ, or -1 if they are not one edit apart."""
    if len(x) > len(y) or len(y) - len(x) > 1 or x == y:
        return -1
    p = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), len(x))
    return p if x[p + (len(x) == len(y)):] == y[p + 1:] else -1


def near_pairs(key: np.ndarray, hole: np.ndarray, base: np.ndarray, word: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (sorted by key) that are near and whose first difference lies in their hole."""
    size = np.fromiter(map(len, word), np.int64, len(word))
    letter = _letter()[np.frombuffer("".join(word).encode("latin-1"), np.uint8)]
    row = np.repeat(np.arange(len(word)), size)
    counts = np.bincount(row * LETTERS + letter - 1, minlength=len(word) * LETTERS).reshape(-1, LETTERS).astype(np.float32)
    square = np.einsum("ij,ij->i", counts, counts)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
    # Tiles: whole groups up to TILE rows; a larger group alone, all pairs of its tiles.
    left, right = [], []

    def multiply(a: slice, b: slice) -> None:
        apart = square[a, None] + square[None, b] - 2 * (counts[a] @ counts[b].T)
        i, j = np.nonzero((apart <= 2.5) & (group[a, None] == group[None, b]))
        i, j = i + a.start, j + b.start
        left.append(i[i < j])
        right.append(j[i < j])

    ends = np.append(first[1:], len(key))
    g = 0
    while g < len(first):
        start = int(first[g])
        g = max(g + 1, int(np.searchsorted(ends, start + TILE, "right")))
        stop = int(ends[g - 1])
        for a in range(start, stop, TILE):
            for b in range(a, stop, TILE):
                multiply(slice(a, min(a + TILE, stop)), slice(b, min(b + TILE, stop)))
    x, y = np.concatenate(left), np.concatenate(right)
    x, y = np.where(size[x] <= size[y], x, y), np.where(size[x] <= size[y], y, x)
    fits = (base[x] == base[y]) & (hole[x] == hole[y]) & (size[x] == base[x]) & (size[y] - size[x] <= 1)
    x, y = x[fits], y[fits]
    # The first difference, or -1, of each pair; short words as rows of one matrix.
    place = np.full(len(x), -1)
    short = np.flatnonzero(size[y] <= WIDTH)
    width = int(min(size.max(initial=0), WIDTH)) + 2
    code = np.zeros((len(word), width), np.uint8)
    begin = np.cumsum(size) - size
    inside = size[row] <= WIDTH
    code[row[inside], (np.arange(len(row)) - begin[row])[inside]] = letter[inside]
    for a in range(0, len(short), ROWS):
        some = short[a : a + ROWS]
        m, n = code[x[some]], code[y[some]]
        differ = m != n
        p = differ.argmax(axis=1)
        shifted = (m[:, :-1] != n[:, 1:]) & (np.arange(width - 1) >= p[:, None])
        good = np.where(size[x[some]] == size[y[some]], differ.sum(axis=1) == 1, differ.any(axis=1) & ~shifted.any(axis=1))
        place[some] = np.where(good, p, -1)
    for q in np.flatnonzero(size[y] > WIDTH).tolist():
        place[q] = edited(word[x[q]], word[y[q]])
    b = base[x]
    k = np.minimum(-(-b // PIECE), HOLES)
    own = np.minimum(((place + 1) * k - 1) // b, k - 1)
    good = (place >= 0) & (own == hole[x])
    return x[good], y[good]


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word and group with a near word: their number, the largest count among them and the words that have it."""
    names = ["word", "near", "most", "form"]

    def work(t: pa.Table) -> pa.RecordBatch | None:
        key = t.column("key").to_numpy()
        alone = np.append(True, key[1:] != key[:-1]) & np.append(key[1:] != key[:-1], True)
        t = t.filter(pa.array(~alone))
        if not len(t):
            return None
        word, n = t.column("word").to_pylist(), t.column("n").to_numpy()
        x, y = near_pairs(t.column("key").to_numpy(), t.column("hole").to_numpy(), t.column("base").to_numpy().astype(np.int64), word)
        if not len(x):
            return None
        a, b = np.concatenate([x, y]), np.concatenate([y, x])
        order = np.lexsort((-n[b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        runs = np.diff(np.append(first, len(a)))
        most = np.repeat(n[b][first], runs)
        near = np.zeros(len(a), np.int64)
        near[first] = runs
        best = np.flatnonzero(n[b] == most)
        take = t.column("word").combine_chunks()
        return pa.RecordBatch.from_arrays([take.take(pa.array(a[best])), pa.array(near[best]), pa.array(most[best]), take.take(pa.array(b[best]))], names=names)

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows < ROWS:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        key = t.column("key").to_numpy()
        cut = int(np.searchsorted(key, key[-1]))       # the last key may go on in the next batch
        if cut:
            if (out := work(t.slice(0, cut))) is not None:
                yield out
            held = t.slice(cut).to_batches()
            rows = len(key) - cut
    if held and (out := work(pa.Table.from_batches(held).combine_chunks())) is not None:
        yield out


def near(counted: DataFrame) -> DataFrame:
    """``word, n_near, most, best``: number of near words, the largest count among them, and the first word that has it."""
    python_ready(counted.sparkSession)
    dealt = keys(counted).repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(_found, "word string, near long, most long, form string")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("most")).alias("m"), "form")).alias("best")).select(
        "word", "n_near", (-F.col("best.m")).alias("most"), F.col("best.form").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the ends of the chains, by pointer doubling over written tables."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                      "spelling-roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts."""
    counted = written(words(docs, key, text), "spelling-words")
    close = written(near(counted), "spelling-near")
    d = counted.join(close, "word", "left")
    strong = F.col("most") >= TIMES * F.col("n")
    d = written(d.select("word", F.when(strong, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                         F.when(strong, F.col("most")).alias("form_n")), "spelling-forms")
    ends = roots(d.where("form IS NOT NULL").select("word", "form"))
    return d.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
