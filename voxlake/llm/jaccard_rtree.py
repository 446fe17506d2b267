r"""Exact n-gram Jaccard self-join with a count-vector R-tree.

A document's set holds its distinct ``width``-word shingles (words ``[^\x20\x09-\x0D]+`` of the whole
text, A-Z lower-cased; a text with fewer words is one shingle). Two documents link when
``whole * |A & B| >= share * |A | B|``. The result gives every document its set size and the smallest
``doc_id`` it reaches over links.

1. **Classes.** Texts with equal sets form a class, named by 64 bits of a digest of the set, so a
   group of copies is one point from here on, however many rows it has.
2. **Blocks.** Shingles are put into one order for the whole table, rare ones first: by how often their slot of a
   tally of ``SLOTS`` slots is hit, then by hash. Linked sets share a shingle among the first ``n - ceil(n * share / whole) + 1``
   of each, so the equi-key is one shingle of that prefix. Any order that all sets share is lossless; the tally only
   keeps passages that many texts share out of the prefixes, as each text has rarer shingles of its own. The first shingle
   that two linked sets share lies still earlier in the smaller one, and their sizes are alike: classes of a key that are
   too far apart in size, or below the first that holds it early, make no block (``meeting``).
   Without ``rare`` (small allowed differences, long groups): sets whose sizes a link allows share size bands. In a band, shingles are hashed into
   one more group than a linked pair can differ by, plus some spare ones, so linked sets agree on a whole
   group: the equi-key is (band, group, content of the group). Empty groups are no key; sets with more of
   them than the spare ones are hashed anew, and only after ``LEVELS`` times is emptiness itself a key,
   which keeps the scheme lossless. A text passage that many documents share does not make a block, as the
   rest of each group differs. Either way keys travel packed, five bytes each and eleven for a class with its keys in a
   bucket, one row for a bucket and about ``KEYS`` keys, and only keys that several classes hold leave the task.
3. **Stars.** A block's hub is its class that lies in the most blocks; a star is a hub with the classes of its
   blocks. Stars that share classes make a family, dealt out in tiles of about ``TILE`` classes and ``TILE_SHINGLES``
   shingles at most. A text comes to a tile's task once, however many stars hold it. Where that costs more copies than
   the stars by themselves, as in a family of unrelated texts that hang together by passages, each star is dealt out alone.
4. **Count-vector R-tree.** In a tile, shingles are hashed into ``DIMS`` groups; the group counts of a class are a
   point. The points are bulk-loaded into one R-tree (star, then size, then counts; leaves of ``FANOUT``), joined
   with itself level by level: a pair of nodes survives if stars meet, sizes fit, labels may differ and the
   summed coordinate minima of their upper corners reach the overlap that a link needs. Every link comes out of
   such a join.
5. **Verification** of surviving pairs on the texts' sets, exact. The trees are joined with count vectors first, which
   tells the classes that are in any surviving pair; of long texts the pair must also survive finer vectors, with at most
   ``LOAD`` shingles to a coordinate. Only their texts travel, and a second join verifies its pairs in the same task. Candidates are never rows, and a tile gives as many links as join its classes, not all of them.
6. **Two rounds.** First the hub's pairs only (nodes without a hub do not meet). Stars whose classes have then all met in one
   component are settled. In the others, the classes outside the star's largest component meet all of the star, for pairs
   of different components (the classes of a block share its hub, so each of their pairs is looked at). So a group of
   mutual near copies costs a star, not all its pairs, and no link between components is missed. A group
   whose similarities lie about the threshold costs a look at all its pairs, but no rows for them.

The R-tree alone would not do: in tens of dimensions the corners of a node of unrelated texts bound
nothing, and the join would compare all texts of a size. The equi-key of step 2 only deals the points
to shards.

Recovery: all intermediate tables are written under ``spark.checkpoint.dir`` and reread. Broadcasts are
taken below ``MAX_BROADCAST`` counted rows, else the join shuffles.

Defined cases: a null or blank text has an empty set (size 0), links with nothing and is its own
component; rows that repeat a ``doc_id`` are one document with several texts, linked by the id; a null
``doc_id`` gets the component of its copies, or null; very long texts are one row each; an empty table
gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.bpe_scan import in_slices
from voxlake.llm.common import python_ready, unused_gone, written

WIDTH, SHARE, WHOLE = 3, 90, 100
DIM_BITS = 8
DIMS = 1 << DIM_BITS    # coordinates of a count vector in the tree
LOAD = 4                # shingles to a coordinate of a stored vector at most, on average
FANOUT = 16
TILE = 2048             # classes of a star in one task
TILE_SHINGLES = 1_000_000   # their shingles, about
BUCKET_KEYS = 2_000_000     # keys of a bucket, about
LEAST_BUCKETS = 64      # that small tables are spread over, if there are as many partitions
LEVELS = 4
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS  # of the tally of shingles
PART = 1 << 14          # slots of the tally in one row
TASKS = 64              # tasks whose counts are summed first
STEP = 1.04             # ratio of sizes from one level to the next
CHARS = 500_000         # of texts hashed at once
KEYS = 500_000          # keys packed at once, about
KEY_BYTES = 5           # a chance agreement of keys only costs a look
MAX_BROADCAST = 1_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)        # 2**64 / golden ratio: an odd multiplier
_BASE = 0xD6E8FEB86659FD93                  # odd base of the word polynomial
_CHUNK = 1 << 13        # pairs whose bounds are computed at once


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses modulo 2**64, up to n."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.ones(1, np.uint64)
            while len(out) < size:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
            _powers[name] = out
    return _powers["up"][:n], _powers["down"][:n]


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw = [t.encode().lower() for t in texts]           # bytes.lower() changes A-Z only
    data = np.frombuffer(b"\n".join([b"", *raw, b""]), np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1      # starts and ends of words in turn
    begin, end = edge[0::2], edge[1::2]
    up, down = powers(len(data))
    upto = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up)
    word = mix((upto[end - 1] - upto[begin - 1]) * down[begin] + (end - begin).astype(np.uint64) * _ODD)
    gram = word.copy()
    whole = max(0, len(word) - width + 1)
    gram = gram[:whole]
    for i in range(1, width):
        gram = mix(gram * _ODD + word[i : i + whole])
    at = np.cumsum([1, *(len(r) + 1 for r in raw)])         # where each text begins
    first = np.searchsorted(begin, at)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(gram[a : b - width + 1]))
        elif b > a:
            h = np.array([b - a], np.uint64)
            for i in range(a, b):
                h = mix(h * _ODD + word[i])
            out.append(h)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def class_of(shingles: np.ndarray) -> int | None:
    """The name of a set: 64 bits of its digest; none for the empty set."""
    if not len(shingles):
        return None
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def dim_bits(n: int) -> int:
    """The stored vector of a set of n shingles has two to this power coordinates: in few of them, long texts all look
    alike, as every coordinate holds about as much in each."""
    return max(DIM_BITS, (n // LOAD).bit_length())


def counts_of(shingles: np.ndarray, bits: int = DIM_BITS) -> np.ndarray:
    """The count vector: how many shingles fall into each of ``1 << bits`` groups."""
    return np.bincount((mix(shingles) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def folded(counts: np.ndarray, bits: int) -> np.ndarray:
    """The vector of the same set in fewer groups."""
    return counts.reshape(1 << bits, -1).sum(axis=1, dtype=np.int32)


def packed(counts: np.ndarray) -> bytes:
    """A count vector as bytes: one for each count, or four where a count needs them."""
    return counts.astype(np.uint8 if counts.max() < 1 << 8 else "<u4").tobytes()


def unpacked(vector: bytes, n: int) -> np.ndarray:
    """The stored count vector of a set of n shingles."""
    return np.frombuffer(vector, np.uint8 if len(vector) == 1 << dim_bits(n) else "<u4").astype(np.int32)


def slots_of(shingles: np.ndarray) -> np.ndarray:
    """The slot of the tally that each shingle hits."""
    return (mix(shingles + np.uint64(_BASE)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def bands(longest: int, share: int, whole: int) -> np.ndarray:
    """First sizes of the size bands: each about (whole / share)**2 times the last."""
    out = [1]
    while out[-1] <= longest:
        out.append(max(out[-1] + 1, -(-out[-1] * whole * whole // (share * share))))
    return np.array([*out, -(-out[-1] * whole * whole // (share * share))], np.int64)


def group_keys(sets: list[np.ndarray], share: int, whole: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and for each the index of its set: groups of shingles, see step 2 of the module's text."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if not len(sizes) or not sizes.max():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    firsts = bands(int(sizes.max()), share, whole)
    own = np.searchsorted(firsts, sizes, "right") - 1
    # A set also joins the next band if a set of that band may link with it.
    upward = (sizes > 0) & (sizes * whole >= share * firsts[np.maximum(own, 0) + 1])
    which = np.concatenate([np.flatnonzero(sizes), np.flatnonzero(upward)])
    band = np.concatenate([own[sizes > 0], own[upward] + 1])
    differ = 2 * (firsts[band + 1] - 1) * (whole - share) // (whole + share)
    some = differ > 0                       # else only equal sets link, and they are one class
    which, band, differ = which[some], band[some], differ[some]
    # Spare groups for the empty ones: with at most that many, an agreeing group is not empty.
    smallest = np.maximum(firsts[band] * share // whole, 1)
    spare = np.ceil((differ + 1) * np.exp(-smallest / (differ + 1))).astype(np.int64) + 2
    groups = differ + 1 + spare
    keys, owner = [], []
    for level in range(LEVELS):
        if not len(which):
            break
        n = sizes[which]
        item = np.concatenate([sets[i] for i in which.tolist()])
        seeded = mix(item + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        start = np.cumsum(groups) - groups
        slot = np.repeat(start, n) + ((seeded >> np.uint64(32)) * np.repeat(groups, n).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        total = int(groups.sum())
        body = mix(seeded)
        low = np.bincount(slot, (body & np.uint64(0xFFFFFFFF)).astype(np.float64), total).astype(np.uint64)
        high = np.bincount(slot, (body >> np.uint64(32)).astype(np.float64), total).astype(np.uint64)
        held = np.bincount(slot, minlength=total)
        at = np.repeat(np.arange(len(which)), groups)
        place = (np.arange(total) - start[at]).astype(np.uint64) + (band[at].astype(np.uint64) << np.uint64(40)) + np.uint64(level << 56)
        key = mix(mix(low * _ODD + high) + mix(place))
        use = (held > 0) | (level == LEVELS - 1)
        keys.append(key[use])
        owner.append(which[at[use]])
        again = np.bincount(at[held == 0], minlength=len(which)) > spare
        which, band, groups, spare = which[again], band[again], groups[again], spare[again]
    return np.concatenate(keys or [np.empty(0, np.uint64)]), np.concatenate(owner or [np.empty(0, np.int64)])


def prefix_keys(sets: list[np.ndarray], share: int, whole: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, for each the index of its set, and whether it is one of the set's early ones: the first shingle that two
    linked sets share is among the first ``n - ceil(2 * n * share / (whole + share)) + 1`` of the smaller one."""
    sizes = np.array([len(s) for s in sets], np.int64)
    some = np.flatnonzero(sizes * whole // share > sizes)       # else only equal sets link, and they are one class
    if not len(some):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool)
    n = sizes[some]
    item = np.concatenate([sets[i] for i in some.tolist()])
    key = mix(item) >> np.uint64(8)
    key |= ranks[slots_of(item)].astype(np.uint64) << np.uint64(56)
    prefix = n - -(-share * n // whole) + 1
    early = n - -(-2 * share * n // (whole + share)) + 1
    ends = np.cumsum(n)
    keys = [np.partition(key[b - m : b], (e - 1, k - 1))[:k] for b, m, k, e in zip(ends.tolist(), n.tolist(), prefix.tolist(), early.tolist())]
    place = np.arange(prefix.sum()) - np.repeat(np.cumsum(prefix) - prefix, prefix)
    return mix(np.concatenate(keys)), np.repeat(some, prefix), place < np.repeat(early, prefix)


def block_keys(sets: list[np.ndarray], share: int, whole: int, ranks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and for each the index of its set: see step 2 of the module's text. ``ranks``: a byte for each slot of the
    tally, smaller for rarer shingles; without it the keys are groups of shingles."""
    return group_keys(sets, share, whole) if ranks is None else prefix_keys(sets, share, whole, ranks)[:2]


def size_levels(sizes: np.ndarray) -> np.ndarray:
    """Sizes as bytes: the logarithm to the base STEP, as far as a byte goes."""
    return np.minimum(np.log(np.maximum(sizes, 1)) / np.log(STEP), 255).astype(np.uint8)


def level_gap(share: int, whole: int) -> int:
    """How far the levels of two sets that link can lie apart."""
    return int(np.log(whole / share) / np.log(STEP) + 1e-6) + 1


def meeting(keys: np.ndarray, classes: np.ndarray, levels: np.ndarray, early: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all blocks, one block after the other, and the blocks' sizes: classes that share a key, as far as
    one of them may link with another by their sizes and by which of the keys are early."""
    order = np.lexsort((~early, classes, levels, keys))
    keys, classes, levels, early = keys[order], classes[order], levels[order].astype(np.int64), early[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (classes[1:] != classes[:-1])
    keys, classes, levels, early = keys[new], classes[new], levels[new], early[new]
    cut = np.ones(len(keys), bool)
    cut[1:] = (keys[1:] != keys[:-1]) | (levels[1:] - levels[:-1] > gap)
    block = np.cumsum(cut) - 1
    # The smaller set of a linked pair holds the key early, so nothing below the first such set links.
    lowest = np.minimum.reduceat(np.where(early, levels, 256), np.flatnonzero(cut)) if len(keys) else levels
    use = levels >= lowest[block]
    size = np.bincount(block[use], minlength=0)
    return classes[use][size[block[use]] > 1], size[size > 1]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column(1).to_pylist()]


def points(docs: DataFrame, width: int) -> DataFrame:
    """``id, n, class, counts, h`` of ``(id, t, h)`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, some in in_slices(_texts(batch), CHARS):
                sets = shingle_sets(some, width)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, len(some)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_of(s) for s in sets], pa.int64()), pa.array([packed(counts_of(s, dim_bits(len(s)))) for s in sets], pa.binary()),
                    batch.column(2).slice(a, len(some))], names=["id", "n", "class", "counts", "h"])

    return docs.mapInArrow(run, "id long, n long, class long, counts binary, h long")


def tally(docs: DataFrame, width: int) -> np.ndarray:
    """A byte for each slot: the logarithm of how many shingles of all rows hit it. Each task counts its rows; the
    counts are summed by part of the slots, over groups of tasks first. Counts travel in as few bytes as they need."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, some in in_slices(_texts(batch), CHARS):
                hits += np.bincount(slots_of(np.concatenate(shingle_sets(some, width))), minlength=SLOTS)
        if hits.any():
            parts = hits.reshape(-1, PART)
            task = TaskContext.get().partitionId() // TASKS
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array(np.full(len(parts), task)),
                                              pa.array([short(v) for v in parts], pa.binary())], names=["part", "task", "hits"])

    def short(hits: np.ndarray) -> bytes:
        most = min(int(hits.max()), (1 << 32) - 1)      # only an order, so it may stop there
        return np.minimum(hits, most).astype(np.min_scalar_type(most).newbyteorder("<")).tobytes()

    def total(table: pa.Table) -> pa.Table:
        hits = np.zeros(PART, np.int64)
        for v in table.column("hits"):
            hits += np.frombuffer(v.as_py(), f"<u{len(v.as_py()) // PART}")
        task = pa.array([table.column("task")[0].as_py() // TASKS])
        return pa.table({"part": table.column("part")[:1], "task": task, "hits": pa.array([short(hits)], pa.binary())})

    schema = "part long, task long, hits binary"
    found = docs.mapInArrow(count, schema)
    for by in (["part", "task"], ["part", "task"], ["part"]):
        found = found.groupBy(*by).applyInArrow(total, schema)
    ranks = np.zeros(SLOTS, np.uint8)
    for row in found.collect():
        hits = np.frombuffer(row.hits, f"<u{len(row.hits) // PART}").astype(np.float64)
        ranks[row.part * PART : (row.part + 1) * PART] = np.minimum(np.log2(hits + 1) * 8, 255)
    return ranks


def blocks(docs: DataFrame, width: int, share: int, whole: int, buckets: int, rare: bool = True) -> DataFrame:
    """``block, class, size`` rows of every block with at least two classes; equal blocks appear once."""
    ranks = docs.sparkSession.sparkContext.broadcast(tally(docs, width) if rare else None)
    gap = level_gap(share, whole)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for _, some in in_slices(_texts(batch), CHARS):
                sets = shingle_sets(some, width)
                names = [class_of(s) for s in sets]
                first = {c: i for i, c in reversed(list(enumerate(names))) if c is not None}
                sets = [sets[i] for i in first.values()]
                if ranks.value is None:
                    keys, owner = group_keys(sets, share, whole)
                    early = np.ones(len(keys), bool)
                else:
                    keys, owner, early = prefix_keys(sets, share, whole, ranks.value)
                if len(keys):
                    levels = size_levels(np.array([len(s) for s in sets]))
                    held.append((keys, np.array(list(first), np.int64)[owner], levels[owner], early))
                    n += len(keys)
                if n >= KEYS:
                    yield rows(*map(np.concatenate, zip(*held)))
                    held, n = [], 0
        if held:
            yield rows(*map(np.concatenate, zip(*held)))

    def rows(keys: np.ndarray, classes: np.ndarray, levels: np.ndarray, early: np.ndarray) -> pa.RecordBatch:
        bucket = (mix(keys) >> np.uint64(32)).astype(np.int64) % buckets
        order = np.lexsort((~early, classes, bucket))
        keys, classes, levels, early, bucket = keys[order], classes[order], levels[order], early[order], bucket[order]
        new = np.ones(len(keys), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (classes[1:] != classes[:-1])
        run = np.flatnonzero(new)
        place = np.arange(len(keys)) - np.repeat(run, np.diff(np.append(run, len(keys))))
        run = np.flatnonzero(place % 255 == 0)      # a class with its keys, as many as a byte can count
        n = np.diff(np.append(run, len(keys))).astype(np.uint8)
        at_first = np.add.reduceat(early, run, dtype=np.uint8)
        cut = np.flatnonzero(np.diff(bucket[run], prepend=-1))
        first = run[cut]
        low = np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES])
        of = [(low, first, len(keys)), *((v, cut, len(run)) for v in (classes[run], levels[run], n, at_first))]
        return pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int64()), *(
            pa.array([v[a:b].tobytes() for a, b in zip(at.tolist(), [*at[1:].tolist(), end])], pa.binary()) for v, at, end in of)],
            names=["bucket", "keys", "classes", "levels", "n", "early"])

    def meet(table: pa.Table) -> pa.Table:
        raw, classes, levels, n, early = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (
            ("keys", np.uint8), ("classes", np.int64), ("levels", np.uint8), ("n", np.uint8), ("early", np.uint8)))
        wide = np.zeros((len(raw) // KEY_BYTES, 8), np.uint8)
        wide[:, :KEY_BYTES] = raw.reshape(-1, KEY_BYTES)
        n = n.astype(np.int64)
        place = np.arange(len(wide)) - np.repeat(np.cumsum(n) - n, n)
        classes, levels, early = np.repeat(classes, n), np.repeat(levels, n), place < np.repeat(early, n)
        classes, size = meeting(wide.view(np.uint64).reshape(-1), classes, levels, early, gap)
        if not len(size):
            return pa.table({c: pa.array([], pa.int64()) for c in ("block", "class", "size")})
        # A block is named by its members, so that the many keys a cluster shares make one block.
        starts = np.cumsum(size) - size
        name = mix(np.add.reduceat(mix(classes.view(np.uint64)), starts) + size.astype(np.uint64)).view(np.int64)
        _, once = np.unique(name, return_index=True)
        kept = np.zeros(len(size), bool)
        kept[once] = True
        member = np.repeat(kept, size)
        return pa.table({"block": np.repeat(name, size)[member], "class": classes[member], "size": np.repeat(size, size)[member]})

    sent = docs.mapInArrow(emit, "bucket long, keys binary, classes binary, levels binary, n binary, early binary")
    return sent.groupBy("bucket").applyInArrow(meet, "block long, class long, size long").distinct()


def _levels(block: np.ndarray, size: np.ndarray, counts: np.ndarray, label: np.ndarray, hub: np.ndarray) -> list[dict[str, np.ndarray]]:
    """Bulk-loaded R-tree, leaves first: per node the ranges of blocks and sizes, the upper corner, and whether a
    hub is below."""
    levels = [{"b0": block, "b1": block, "s0": size, "s1": size, "top": counts, "l0": label, "l1": label, "hub": hub}]
    while len(levels[-1]["b0"]) > 1:
        below = levels[-1]
        at = np.arange(0, len(below["b0"]), FANOUT)
        levels.append({"b0": below["b0"][at], "b1": np.maximum.reduceat(below["b1"], at), "s0": np.minimum.reduceat(below["s0"], at),
                       "s1": np.maximum.reduceat(below["s1"], at), "top": np.maximum.reduceat(below["top"], at),
                       "l0": np.minimum.reduceat(below["l0"], at), "l1": np.maximum.reduceat(below["l1"], at),
                       "hub": np.logical_or.reduceat(below["hub"], at)})
    return levels


def rtree_pairs(block: np.ndarray, size: np.ndarray, counts: np.ndarray, label: np.ndarray, hub: np.ndarray,
                share: int, whole: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j in tree order) of one block, with one of them a hub, that the bound lets pass.
    ``hub``: points that may pair with any; two others never pair. Nodes of one label are skipped."""
    levels = _levels(block, size, counts, label, hub)

    def passing(level: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, leaf: bool) -> np.ndarray:
        ok = (level["b0"][i] <= level["b1"][j]) & (level["b0"][j] <= level["b1"][i])
        ok &= (whole * level["s1"][i] >= share * level["s0"][j]) & (whole * level["s1"][j] >= share * level["s0"][i])
        ok &= (level["l0"][i] != level["l1"][j]) | (level["l1"][i] != level["l0"][j])      # some labels differ
        ok &= level["hub"][i] | level["hub"][j]
        if leaf:
            ok &= i < j
        for a in range(0, len(i), _CHUNK):
            at = a + np.flatnonzero(ok[a : a + _CHUNK])
            bound = np.minimum(level["top"][i[at]], level["top"][j[at]]).sum(axis=1, dtype=np.int64)
            ok[at] = (whole + share) * bound >= share * (level["s0"][i[at]] + level["s0"][j[at]])
        return ok

    def down(depth: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ok = passing(levels[depth], i, j, depth == 0)
        i, j = i[ok], j[ok]
        if depth == 0:
            if len(i):
                yield i, j
            return
        n = len(levels[depth - 1]["b0"])
        for a in range(0, len(i), _CHUNK // (FANOUT * FANOUT)):
            p, q = i[a : a + _CHUNK // (FANOUT * FANOUT)], j[a : a + _CHUNK // (FANOUT * FANOUT)]
            child = np.arange(FANOUT)
            x = np.broadcast_to((p[:, None] * FANOUT + child)[:, :, None], (len(p), FANOUT, FANOUT)).reshape(-1)
            y = np.broadcast_to((q[:, None] * FANOUT + child)[:, None, :], (len(p), FANOUT, FANOUT)).reshape(-1)
            # Node pairs with themselves give both orders of their children: one is enough.
            use = (x < n) & (y < n) & (x <= y)
            yield from down(depth - 1, x[use], y[use])

    if len(block):
        yield from down(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))


def stars(members: DataFrame) -> DataFrame:
    """``hub, class``: each class with the hub of every block it lies in. A block's hub is its class that lies
    in the most blocks (the least edited text lies in all of its copies' blocks, so blocks of one group agree
    on it); ties go to the smaller class."""
    degree = members.groupBy("class").agg(F.count("*").alias("d"))
    ranked = members.join(degree, "class")
    hubs = ranked.groupBy("block").agg(F.max(F.struct("d", (-F.col("class")).alias("c"))).alias("h"))
    both = members.join(hubs.select("block", (-F.col("h.c")).alias("hub")), "block")
    return both.where("class <> hub").select("hub", "class").distinct()


def links_of(sets: list[np.ndarray], pairs: Iterator[tuple[np.ndarray, np.ndarray]], label: np.ndarray, share: int,
             whole: int) -> list[tuple[int, int]]:
    """Index pairs whose sets link, out of candidate pairs: as many as join all the labels that links join. Pairs of
    labels that have met are not looked at again."""
    names, own = np.unique(label, return_inverse=True)
    own, up = own.tolist(), list(range(len(names)))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    words, local = np.unique(np.concatenate(sets), return_inverse=True)
    sets = np.split(local.reshape(-1), np.cumsum([len(s) for s in sets])[:-1])
    here, out = np.zeros(len(words), np.uint8), []
    for first, second in pairs:
        order = np.argsort(first, kind="stable")
        first, second = first[order], second[order]
        cut = np.flatnonzero(np.diff(first, prepend=-1)).tolist()
        for a, b in zip(cut, [*cut[1:], len(first)]):
            i = int(first[a])
            root = find(own[i])
            others = [j for j in second[a:b].tolist() if find(own[j]) != root]
            if not others:
                continue
            n = np.array([len(sets[j]) for j in others])
            here[sets[i]] = 1
            both = np.add.reduceat(here[np.concatenate([sets[j] for j in others])], np.cumsum(n) - n, dtype=np.int64)
            here[sets[i]] = 0
            for at in np.flatnonzero(whole * both >= share * (len(sets[i]) + n - both)).tolist():
                x, y = find(own[i]), find(own[others[at]])
                if x != y:
                    up[y] = x
                    out.append((i, others[at]))
    return out


def near_stars(members: DataFrame) -> DataFrame:
    """``star, family``: the smallest star within two steps over shared classes. Stars of one group of near copies
    mostly agree on it, so their texts travel together; a star that does not only costs another copy of a text."""
    spokes = members.select("star", "class")
    low = spokes.withColumn("family", F.col("star"))
    for _ in range(2):
        least = low.groupBy("class").agg(F.min("family").alias("least"))
        family = low.join(least, "class").groupBy("star").agg(F.min("least").alias("family"))
        low = spokes.join(family, "star")
    return family


def dealt(members: DataFrame, buckets: int) -> DataFrame:
    """``bucket, block, class, head, id, label``: each star's classes in the tasks where they meet the star's heads.

    A family's classes are cut into tiles of about ``TILE`` classes and ``TILE_SHINGLES`` shingles at most, its heads
    into sides of that size. A task has one tile and one side of a family, or small families whole, as many as hold
    about one tile's shingles. A class goes to the sides of its stars' heads, a head to the tiles of its stars' classes;
    so a family with few heads costs about one copy of each text, however many tiles it has. A family with many heads,
    as when unrelated texts hang together by passages that two or three of them share, would give each class to most
    sides, which grows with the square: where its stars by themselves get by with half the copies, each is its own family.
    """
    m = members.join(written(near_stars(members), "jaccard-families"), "star")
    cut = lambda use: f"cast(greatest(1, ceil(count_if({use}) / {TILE}), ceil(sum(if({use}, n, 0)) / {TILE_SHINGLES})) as int)"
    tiles, sides, weight = F.expr(cut("true")).alias("tiles"), F.expr(cut("head")).alias("sides"), F.expr(f"sum(greatest(n, {DIMS}))").alias("weight")
    sums = m.groupBy("family", "class", "n").agg(F.max("head").alias("head")).groupBy("family").agg(tiles, sides, weight)
    own = m.groupBy("family", "star").agg(F.struct(tiles, sides, weight).alias("own"), F.count("*").alias("size"), F.expr("count_if(head) AS heads"))
    both = written(own.join(sums, "family"), "jaccard-sizes")
    # Copies of classes that a family's tasks get at most, or those of its stars, each dealt out by itself.
    apart = both.groupBy("family").agg(F.expr("sum(size * least(sides, heads) + heads * least(tiles, size)) > "
                                              "2 * sum(size * own.sides + heads * own.tiles)").alias("apart"))
    sums = written(both.join(apart, "family").selectExpr("star", "if(apart, star, family) AS family", *(
        f"if(apart, own.{k}, {k}) AS {k}" for k in ("tiles", "sides", "weight"))), "jaccard-tiles")
    held = sums.where("tiles = 1").groupBy("family").agg(F.max("weight").alias("weight")).agg(F.sum("weight")).first()[0] or 0
    buckets = max(buckets, -(-held // TILE_SHINGLES))
    m = written(members.join(sums, "star").selectExpr("*", "cast(pmod(xxhash64(class), tiles) as int) AS tile",
                                                      "cast(pmod(xxhash64(class, 1), sides) as int) AS side"), "jaccard-tiled")
    to_side = m.where("head").selectExpr("star", "side AS y").distinct()
    to_tile = m.selectExpr("star", "tile AS x").distinct()
    rows = m.withColumnRenamed("tile", "x").drop("side").join(to_side, "star").unionByName(
        m.where("head").withColumnRenamed("side", "y").drop("tile").join(to_tile, "star"))
    return rows.selectExpr(f"if(tiles > 1, xxhash64(family, x, y), pmod(xxhash64(family), {buckets})) AS bucket",
                           "star AS block", "class", "head", "id", "label").distinct()


def tree_join(rows: pa.Table, names: np.ndarray, counts: np.ndarray, n: np.ndarray, share: int,
              whole: int) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Labels of the classes ``names`` (sorted) and the pairs of their indexes that the trees of all stars in ``rows``
    (``block, class, label, head``) let pass."""
    c = {k: rows.column(k).to_numpy() for k in ("block", "class", "label", "head")}
    c = {k: v[np.isin(c["class"], names)] for k, v in c.items()}
    own, head = np.searchsorted(names, c["class"]), c["head"].astype(bool)
    order = np.lexsort((~head, c["class"], *counts[:, :4].T[:, own], n[own], c["block"]))
    own, head, block, label = own[order], head[order], c["block"][order], c["label"][order]
    once = np.ones(len(own), bool)      # a head may also come as one of the tile's classes
    once[1:] = (own[1:] != own[:-1]) | (block[1:] != block[:-1])
    own, head, block, label = own[once], head[once], block[once], label[once]
    of_set = np.empty(len(names), np.int64)
    of_set[own] = label
    ends = np.append(np.flatnonzero(np.diff(block)) + 1, len(own))

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        a = 0
        while a < len(own):     # whole stars, about a tile at once: a point is a kilobyte
            b = ends[max(np.searchsorted(ends, a + TILE, "right") - 1, np.searchsorted(ends, a, "right"))]
            for i, j in rtree_pairs(block[a:b], n[own[a:b]], counts[own[a:b]], label[a:b], head[a:b], share, whole):
                yield own[i + a], own[j + a]
            a = b

    return of_set, pairs()


def may_link(a: np.ndarray, b: np.ndarray, n: int, share: int, whole: int) -> bool:
    """Do the stored vectors of two sets, of n shingles together, allow a link?"""
    bits = min(len(a), len(b)).bit_length() - 1
    return (whole + share) * int(np.minimum(folded(a, bits), folded(b, bits)).sum()) >= share * n


def star_links(members: DataFrame, vectors: DataFrame, docs: DataFrame, width: int, share: int, whole: int, buckets: int) -> DataFrame:
    """Links ``a, b`` between different labels of each star, enough to join all that its links join. ``members``:
    ``star, class, head, id, label`` (``head``: the pairs with it are looked at; ``id``: a document of the class) and ``n``;
    ``vectors``: ``class, n, counts``.

    The trees are joined twice. The first time with count vectors alone, to learn which classes are in any pair that
    the bound lets pass: one row for a class and task, no pairs. Then with the texts of those, once for a class and
    task, to verify the pairs where they arise.
    """
    def near(points_: pa.Table, rows: pa.Table) -> pa.Table:
        points_ = points_.sort_by("class")
        names, n = points_.column("class").to_numpy(), points_.column("n").to_numpy()
        met = np.zeros(len(names), bool)
        if len(names):
            fine = [unpacked(v.as_py(), k) for v, k in zip(points_.column("counts"), n.tolist())]
            for i, j in tree_join(rows, names, np.stack([folded(v, DIM_BITS) for v in fine]), n, share, whole)[1]:
                left = ~(met[i] & met[j])
                i, j = i[left], j[left]
                ok = (n[i] < LOAD * DIMS) | (n[j] < LOAD * DIMS)      # the tree's vectors are as fine as theirs
                for at in np.flatnonzero(~ok).tolist():
                    ok[at] = may_link(fine[i[at]], fine[j[at]], int(n[i[at]] + n[j[at]]), share, whole)
                met[i[ok]] = met[j[ok]] = True
        return pa.table({"bucket": points_.column("at").filter(pa.array(met)), "class": names[met]})

    def join(texts: pa.Table, rows: pa.Table) -> pa.Table:
        wanted, of = set(rows.column("class").to_pylist()), {}
        for _, some in in_slices([t or "" for t in texts.column("t").to_pylist()], CHARS):
            for found in shingle_sets(some, width):
                if (name := class_of(found)) in wanted:     # rows may repeat an id with another text
                    of[name] = found
        if not of:
            return pa.table({k: pa.array([], pa.int64()) for k in ("a", "b")})
        names = np.array(sorted(of), np.int64)
        sets = [of[k] for k in names.tolist()]
        label, pairs = tree_join(rows, names, np.stack([counts_of(s) for s in sets]).astype(np.int32), np.array([len(s) for s in sets]), share, whole)
        found = links_of(sets, pairs, label, share, whole)
        both = names[np.array(found, np.int64).reshape(-1, 2)]
        return pa.table({"a": both.min(axis=1, initial=np.iinfo(np.int64).max), "b": both.max(axis=1, initial=np.iinfo(np.int64).min)})

    m = written(dealt(members, buckets), "jaccard-dealt")
    points_ = m.selectExpr("bucket AS at", "class AS c").distinct().join(vectors.withColumnRenamed("class", "c"), "c")
    points_ = points_.selectExpr("at", "c AS class", "n", "counts")
    met = points_.groupBy("at").cogroup(m.drop("id").groupBy("bucket")).applyInArrow(near, "bucket long, class long")
    m = written(m.join(written(met, "jaccard-met"), ["bucket", "class"]), "jaccard-left")
    route = written(m.select("bucket", "id").distinct(), "jaccard-route")
    texts = docs.join(F.broadcast(route) if route.count() <= MAX_BROADCAST else route, "id").select("bucket", "t")
    return texts.groupBy("bucket").cogroup(m.drop("id").groupBy("bucket")).applyInArrow(join, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``class, label`` for every end of the edges ``(a, b)``: the smallest class it reaches.

    Smallest labels of neighbours, then the label's own label, until nothing changes; each round is
    written. Hot nodes are partial minima and joins that AQE may split.
    """
    both = written(edges.selectExpr("inline(array(struct(a AS u, b AS v), struct(b AS u, a AS v)))").distinct(), "jaccard-edges")
    labels = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("label")), "jaccard-labels")
    while True:
        near = both.join(labels.select(F.col("u").alias("v"), F.col("label").alias("l")), "v").groupBy("u").agg(F.min("l").alias("l"))
        step = labels.join(near, "u").select("u", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        step = written(step, "jaccard-step")
        jump = step.select(F.col("u").alias("label"), F.col("label").alias("l"))
        labels = written(step.join(jump, "label").select("u", "old", F.least("label", "l").alias("label")), "jaccard-labels")
        if labels.where(F.col("old") != F.col("label")).isEmpty():
            return labels.select(F.col("u").alias("class"), "label")
        labels = labels.select("u", "label")


def linked(docs: DataFrame, width: int = WIDTH, share: int = SHARE, whole: int = WHOLE, key: str = "doc_id",
           text: str = "text", by_id: bool = True, rare: bool = False) -> DataFrame:
    """``key, n_shingles, class, component_id, h`` (a hash of the text) for every row. ``by_id``: do rows that share an
    id belong together, whatever their texts? Else each text is by itself. ``rare``: keys by rare shingles, not by groups; the result is the same."""
    spark = docs.sparkSession
    python_ready(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = parts * 2
    d = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"))
    pts = written(points(d.withColumn("h", F.xxhash64("t")), width), "jaccard-points")
    classes = written(pts.where("n > 0").groupBy("class").agg(F.min("id").alias("id"), F.first("n").alias("n")), "jaccard-classes")
    shingles, sets = classes.agg(F.sum("n"), F.count("*")).first()
    keys = (shingles or 0) * (whole - share) // whole + sets if rare else (shingles or 0) * 8 * (whole - share) * whole // ((whole + share) * share)
    # As few buckets as memory allows: a class is named once for all of its keys in a bucket.
    members = written(blocks(d, width, share, whole, max(min(parts, LEAST_BUCKETS), -(-keys // BUCKET_KEYS)), rare), "jaccard-blocks")
    unused_gone(spark)
    star = written(stars(members), "jaccard-stars")
    where = classes.where("id IS NOT NULL")
    spokes = star.selectExpr("hub AS star", "class", "false AS head").union(star.selectExpr("hub", "hub", "true").distinct())
    spokes = written(spokes.join(where, "class").withColumn("label", F.col("class")), "jaccard-spokes")
    held = written(spokes.select("class").distinct(), "jaccard-held")
    vectors = pts.join(F.broadcast(held) if held.count() <= MAX_BROADCAST else held, "class", "left_semi").groupBy("class").agg(
        F.first("n").alias("n"), F.first("counts").alias("counts"))
    vectors = written(vectors, "jaccard-vectors")
    links = written(star_links(spokes, vectors, d, width, share, whole, buckets), "jaccard-links")
    if by_id:
        # Rows that repeat an id with another text: their classes belong together.
        twice = pts.where("n > 0 AND id IS NOT NULL").groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a < z")
        same = pts.join(twice, "id").where("class > a").select("a", F.col("class").alias("b")).distinct()
        links = written(links.union(same), "jaccard-links")
    unused_gone(spark)
    labels = components(links)

    # Stars whose classes, but for the hub, have not all met: the rest of their pairs. Classes of a block
    # share its hub, so no pair of a block is missed. Of two classes of different components one at least is
    # outside the star's largest, so those outside are the heads.
    met = spokes.where("NOT head").drop("label", "head").join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    parts = met.groupBy("star", "label").agg(F.count("*").alias("size"))
    open_ = parts.groupBy("star").agg(F.expr("max_by(label, struct(size, label)) AS largest"), F.count("*").alias("parts")).where("parts > 1")
    rest = written(met.join(open_, "star").withColumn("head", F.expr("label <> largest")).drop("largest", "parts"), "jaccard-open")
    if not rest.isEmpty():
        more = written(star_links(rest, vectors, d, width, share, whole, buckets), "jaccard-links")
        unused_gone(spark)
        labels = components(links.union(more))

    found = classes.select("class", "id").join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    least = found.groupBy("label").agg(F.min("id").alias("component_id"))
    of = found.join(least, "label").select("class", "component_id")
    out = pts.join(of, "class", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), "class",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), "h")
    return out


def one_of_each(docs: DataFrame, width: int, share: int, whole: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that link, directly or not, to a smaller id. Of rows that share an id, each
    text is judged by itself: equal ones become one row, other texts stay or go by their own links. Rows without
    an id stay."""
    python_ready(docs.sparkSession)
    of = written(linked(docs, width, share, whole, key, text, by_id=False, rare=True), "jaccard-result")
    gone = of.where(f"`{key}` <> component_id").select(F.col(key).alias("jaccard_id"), F.col("h").alias("jaccard_h")).distinct()
    gone = written(gone, "jaccard-gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("jaccard_row"), F.col(key).cast("long").alias("jaccard_key"),
                       F.xxhash64(F.col(text)).alias("jaccard_of"))
    kept = rows.join(F.broadcast(gone) if gone.count() <= MAX_BROADCAST else gone,
                     F.expr("jaccard_key = jaccard_id AND jaccard_of = jaccard_h"), "left_anti")
    twice = of.where(f"`{key}` IS NOT NULL").groupBy(key, "h").count().where("count > 1")
    if not twice.isEmpty():
        kept = kept.where("jaccard_key IS NULL").union(kept.where("jaccard_key IS NOT NULL").dropDuplicates(["jaccard_key", "jaccard_of"]))
    return kept.select(*[F.col(f"jaccard_row.`{c}`") for c in docs.columns])
