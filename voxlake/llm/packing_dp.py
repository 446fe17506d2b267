"""Packing by order-preserving dynamic programming with a monotone queue.

The documents of a partition, in table order, form one stream of ids (each document's ids, then
``end_id``). Windows of at most ``size`` ids tile the stream; candidate cuts are the ends of documents
(free), of sentences (``SENTENCE`` ids of penalty) and, within stretches that have neither, every
``size / STRIDES`` ids (``HARD``). A window costs its padding to ``size``, nothing if its length is a power of
two, plus ``EACH``; the cheapest chain of cuts follows from

    cost[j] = penalty[j] + min over i of cost[i] + padding(at[j] - at[i]),

where the first term of ``cost[i] + at[i] + (size - at[j])`` is a sliding-window minimum, kept in a
monotone queue (each candidate enters and leaves once), and the powers of two are a few exact lookups.

A stream is solved in blocks of about ``BLOCK`` ids that end with a document, so that memory is
bounded; a block's last window may be short. Sequences are numbered by partition and order, and a
retried task repeats its partition exactly. No shuffle: ids never leave their task.

Defined cases: a null text is an empty document (its one id is ``end_id``); repeated rows are packed
each; an empty table gives an empty table; a document longer than a window spans several; other columns
of the input are ignored (``pack``) or carried (none).
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from voxlake.llm.bpe_scan import in_slices, model_cache, tokenizer
from voxlake.llm.common import python_ready

SIZE = 1024
SENTENCE, HARD, EACH = 4.0, 32.0, 1.0
STRIDES = 8             # hard cuts, in stretches without better ones, at this part of a window
BLOCK = 1_000_000
SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def candidates(total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions of a stream (0 and ``total`` included) and their penalties."""
    soft = np.union1d(np.append(doc_ends, [0, total]), sentence_ends)
    stride = max(1, size // STRIDES)
    gaps = np.flatnonzero(np.diff(soft) > 2 * stride)
    hard = [np.arange(soft[g] + stride, soft[g + 1] - stride // 2, stride) for g in gaps]
    at = np.union1d(soft, np.concatenate(hard)) if hard else soft
    penalty = np.full(len(at), HARD)
    penalty[np.searchsorted(at, soft)] = SENTENCE
    penalty[np.searchsorted(at, np.append(doc_ends, [0, total]))] = 0.0
    return at.astype(np.int64), penalty


def cheapest_cuts(at: np.ndarray, penalty: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Positions of the cheapest windows' ends, in order (without 0)."""
    n = len(at)
    # Exact powers of two: pairs (candidate, earlier one at such a distance), by candidate. A table over the block's
    # positions answers each distance at once.
    number = np.full(int(at[-1]) + 1, -1, np.int32)
    number[at] = np.arange(n)
    late, early = [], []
    k = 1
    while k <= size:
        j = np.arange(int(np.searchsorted(at, k)), n)
        i = number[at[j] - k]
        late.append(j[i >= 0])
        early.append(i[i >= 0])
        k *= 2
    late, early = np.concatenate(late), np.concatenate(early)
    order = np.argsort(late, kind="stable")
    upto = np.searchsorted(late[order], np.arange(n + 1)).tolist()
    exact = early[order].tolist()
    where, pen = at.tolist(), penalty.tolist()
    cost, came = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])      # (cost + at, candidate), increasing
    for j in range(1, n):
        here = where[j]
        while here - where[queue[0][1]] > size:
            queue.popleft()
        best, i = queue[0]
        best += size - here
        if upto[j] < upto[j + 1]:
            for e in exact[upto[j]:upto[j + 1]]:
                if cost[e] < best:
                    best, i = cost[e], e
        best += pen[j] + EACH
        cost[j], came[j] = best, i
        key = best + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], n - 1
    while j:
        cuts.append(where[j])
        j = came[j]
    return np.array(cuts[::-1], np.int64)


def pieces_of(doc_ends: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, start, length, window and offset of every piece of a block."""
    begins = np.concatenate([[0], doc_ends[:-1]])
    left = np.union1d(begins, np.concatenate([[0], cuts[:-1]]))
    right = np.append(left[1:], doc_ends[-1])
    doc = np.searchsorted(doc_ends, left, "right")
    window = np.searchsorted(cuts, left, "right")
    return doc, left - begins[doc], right - left, window, left - np.concatenate([[0], cuts[:-1]])[window]


def ends_sentence(path: str) -> np.ndarray:
    """Per id: does its text end a sentence or hold a line end?"""
    vocab = tokenizer(path).get_vocab(with_added_tokens=True)
    flags = np.zeros(max(vocab.values()) + 1, bool)
    newline = "\u010a"      # the byte-level letter of a line end
    for word, i in vocab.items():
        flags[i] = word[-1:] in (".", "!", "?") or newline in word
    return flags


def pack(docs: DataFrame, path: str, end_id: int = 0, size: int = SIZE, key: str = "doc_id", text: str = "text",
         block: int = BLOCK, added: bool = False) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset. ``added``: are the
    tokenizer's added tokens recognised in the texts?"""
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, flags = model_cache(path), ends_sentence(path)
        first = sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        keys: list[pa.Array] = []
        held: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        total = 0

        def solved() -> pa.RecordBatch:
            nonlocal sequence, total
            ids, n = np.concatenate(held), np.concatenate(lengths)
            ends = np.cumsum(n)
            at, penalty = candidates(total, ends, np.flatnonzero(flags[ids]) + 1, size)
            cuts = cheapest_cuts(at, penalty, size)
            doc, start, length, window, offset = pieces_of(ends, cuts)
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            left = (ends - n)[doc] + start
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(left.tolist(), (left + length).tolist())]
            out = pa.RecordBatch.from_arrays([
                pa.concat_arrays(keys).take(pa.array(doc)),
                *(pa.array(x, pa.int64()) for x in (start, length, np.array(crc), n[doc], window + sequence, offset))],
                names=["k", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            sequence += len(cuts)
            keys.clear(), held.clear(), lengths.clear()
            total = 0
            return out

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, some in in_slices(texts):
                ids, upto = cache.ids(some, added)
                # The end id after each document's ids.
                held.append(np.insert(ids, upto[1:], end_id))
                lengths.append(np.diff(upto) + 1)
                keys.append(batch.column(0).slice(a, len(some)))
                total += len(held[-1])
                if total >= block:
                    yield solved()
        if total:
            yield solved()
        assert sequence - first < 1 << 33

    kind = dict(docs.dtypes)[key]
    d = docs.selectExpr(f"`{key}` AS k", f"`{text}` AS t")
    return d.mapInArrow(run, f"k {kind}, {SCHEMA}").withColumnRenamed("k", key)
