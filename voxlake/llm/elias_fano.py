"""Token shards: concatenated ids with Elias-Fano document boundaries, written and read back.

``write_shards`` range-partitions the documents by key, encodes each partition in ascending key order
and writes it as binary files of about ``IDS_PER_FILE`` ids; ``read_shards`` opens the files and returns
each document's place by ``select`` on the boundaries.

File layout (little-endian): the 8-byte mark, six 8-byte counts (documents, ids, id width, low bits,
bytes of low part, bytes of high part), the keys (8 bytes each), one null flag per key, the low parts of
the boundaries (fixed width, packed), the high parts (unary, one bit set per document), the bit position
of every ``SAMPLE``-th set bit (4 bytes each), and the ids (2 bytes each where the vocabulary allows,
else 4). Boundary ``i`` (ids of the shard up to and with document ``i``) costs ``2 + log2(ids / documents)``
bits; ``select`` jumps to a sample and counts bits from there.

Scale and recovery: one shuffle of the texts (range partitioning, ties in the key split by a hash of
the text, so one repeated key does not meet in one task), encoding streams through slices, and files are
written beside their final name and moved there, so a retried task leaves the same file. Ids before a
shard come from a running sum over the manifest (one row per file). Files lie in the folder that
``spark.checkpoint.dir`` names and are opened by URI, not as local paths.

Defined cases: a null text is an empty document (its one id is ``end_id``); null keys come first;
repeated rows are all written, in a fixed order; an empty table gives no file and an empty table; other
columns of the input are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlake.llm.bpe_scan import in_slices, model_cache, tokenizer
from voxlake.llm.common import python_ready, written
from voxlake.session import scratch_path

MARK = b"EFTOKEN1"
SAMPLE = 64
IDS_PER_FILE = 4_000_000


class EliasFano:
    """A non-decreasing sequence below 2**32 in a packed low part and a unary high part."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        values = values.astype(np.uint64)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        shifts = np.arange(bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).reshape(-1), bitorder="little")
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros((-(-(int(ones[-1]) + 1 if n else 0) // 64)) * 64, np.uint8)
        unary[ones] = 1
        return cls(n, bits, low, np.packbits(unary, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def select(self, index: np.ndarray) -> np.ndarray:
        """Values at the given places."""
        index = np.asarray(index, np.int64)
        words = self.high.view(np.uint64)
        at = self.samples[index // SAMPLE].astype(np.int64)
        rank = index % SAMPLE                       # set bits to pass from the sample on
        word = at // 64
        bits = words[word] & (np.uint64(0xFFFFFFFFFFFFFFFF) << (at % 64).astype(np.uint64))
        while True:
            held = np.bitwise_count(bits).astype(np.int64)
            short = np.flatnonzero(held <= rank)
            if not len(short):
                break
            rank[short] -= held[short]
            word[short] += 1
            bits[short] = words[word[short]]
        # The rank-th set bit within its word.
        place = np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        inside = (np.cumsum(place, axis=1, dtype=np.int64) <= rank[:, None]).sum(axis=1)
        high = word * 64 + inside - index
        low = np.zeros(len(index), np.int64)
        for b in range(self.low_bits):
            bit = index * self.low_bits + b
            low |= ((self.low[bit // 8] >> (bit % 8).astype(np.uint8)) & 1).astype(np.int64) << b
        return (high << self.low_bits) | low


def shard_bytes(keys: np.ndarray, nulls: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> bytes:
    ef = EliasFano.of(ends)
    head = np.array([len(keys), len(ids), ids.itemsize, ef.low_bits, len(ef.low), len(ef.high)], "<u8")
    parts = (head, keys.astype("<i8"), nulls.astype(np.uint8), ef.low, ef.high, ef.samples.astype("<u4"), ids)
    return MARK + b"".join(p.tobytes() for p in parts)


def parse_shard(raw: bytes) -> tuple[np.ndarray, np.ndarray, EliasFano, np.ndarray]:
    """Keys, null flags, boundaries and ids of a shard."""
    if raw[:8] != MARK:
        raise ValueError("not a token shard")
    docs, count, width, low_bits, low, high = np.frombuffer(raw, "<u8", 6, 8).astype(int).tolist()
    at = 56

    def part(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, n, at)
        at += out.nbytes
        return out

    keys, nulls = part("<i8", docs), part("u1", docs)
    ef = EliasFano(docs, low_bits, part("u1", low), part("u1", high).copy(), part("<u4", -(-docs // SAMPLE)))
    return keys, nulls, ef, part(f"<u{width}", count)


def write_shards(docs: DataFrame, path: str, end_id: int = 2, key: str = "doc_id", text: str = "text", added: bool = False) -> DataFrame:
    """Writes the shards; returns the manifest ``(task, part, path, docs, ids, before)``."""
    spark = docs.sparkSession
    python_ready(spark)
    folder = scratch_path(spark, "token-shards")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        cache, task, part = model_cache(path), TaskContext.get().partitionId(), 0
        wide = "<u2" if tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4"
        keys: list[pa.Array] = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def saved() -> pa.RecordBatch:
            nonlocal part
            k, n = pa.concat_arrays(keys), np.concatenate(sizes)
            raw = shard_bytes(k.fill_null(0).to_numpy(), k.is_null().to_numpy(zero_copy_only=False), np.cumsum(n), np.concatenate(ids))
            name = f"{task:08d}-{part:05d}.ids"
            beside = f"{root}/.{name}-{uuid.uuid4().hex}"
            with store.open_output_stream(beside) as out:
                out.write(raw)
            store.move(beside, f"{root}/{name}")
            row = pa.RecordBatch.from_pydict({"task": [task], "part": [part], "path": [f"{folder}/{name}"], "docs": [len(n)], "ids": [int(n.sum())]})
            keys.clear(), ids.clear(), sizes.clear()
            part += 1
            return row

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, some in in_slices(texts):
                found, upto = cache.ids(some, added)
                ids.append(np.insert(found, upto[1:], end_id).astype(wide))
                sizes.append(np.diff(upto) + 1)
                keys.append(batch.column(0).slice(a, len(some)))
                if sum(map(len, ids)) >= IDS_PER_FILE:
                    yield saved()
        if keys:
            yield saved()

    d = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    tie = F.xxhash64("t")
    d = d.repartitionByRange(F.col("k").asc_nulls_first(), tie).sortWithinPartitions(F.col("k").asc_nulls_first(), tie)
    manifest = written(d.mapInArrow(run, "task long, part long, path string, docs long, ids long"), "token-manifest")
    order = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("before", F.coalesce(F.sum("ids").over(order), F.lit(0)))


def read_shards(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document, from the files: key, start (over all shards), n_tokens, ids_crc32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as f:
                    keys, nulls, ef, ids = parse_shard(f.read())
                ends = ef.select(np.arange(ef.count))
                starts = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, pa.int64(), mask=nulls.astype(bool)), pa.array(starts + before),
                    pa.array(ends - starts), pa.array(crc, pa.int64())], names=["k", "start", "n_tokens", "ids_crc32"])

    files = max(1, manifest.count())
    spread = manifest.select("path", "before").repartition(files, "path")
    return spread.mapInArrow(run, "k long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("k", key)
