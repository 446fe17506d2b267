r"""Byte-level BPE: pre-tokenisation by a transition-function scan, cached pair merging, decoding.

The splitting pattern of the rank files (contractions, optional blank plus letters, digits or other
signs, and white space that leaves its last character to what follows) is a finite automaton over
code-point classes. ``piece_offsets`` runs it over arrays: each block of text is a function from entry
state to exit state, functions compose associatively, so all blocks are stepped side by side, their
functions are chained, and a second pass with the true entry states records the state after every
character. Cuts follow from the states and the classes of neighbours; no regex runs.

The slices feed ``PieceCache``: a piece's ids are merged once (by the tokenizer library's own merge of
one piece) and kept for later slices; the cache holds at most ``MAX_CACHED`` pieces, which bounds a
worker's memory, and pieces beyond it are merged again where they occur.

``encode`` keeps, next to the ids, the byte offset at which each piece starts; ``decode`` turns ids
back into bytes. Both are map-only: no shuffle, nothing gathered, texts cut nowhere.

Defined cases: a null text counts as empty (no ids, no offsets, empty bytes); repeated rows give
repeated rows; a text of any length is one row (work arrays are bounded by ``CHARS_AT_ONCE`` plus the
longest text); an empty table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voxlake.llm.common import python_ready

MAX_CACHED = 400_000
CHARS_AT_ONCE = 2_000_000
BLOCK = 128
SEP = "\ud800"          # a lone surrogate: in no valid text, so it can stand between texts
SEP_CP = 0xD800

# Character classes. Letters that occur in contractions have classes of their own.
OTHER, LETTER, DIGIT, BLANK, SPACE, APOS, STMD, R, V, E, L, END = range(12)
CLASSES = 12
# States after a character.
BEGIN, IN_LETTERS, IN_DIGITS, AT_BLANK, AT_SPACE, IN_OTHER, AT_APOS, APOS_R, APOS_V, APOS_L, DONE2, DONE3 = range(12)
STATES = 12
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def class_table() -> np.ndarray:
    kinds = {"L": LETTER, "N": DIGIT}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = SPACE
    table[ord(" ")] = BLANK
    table[ord("'")] = APOS
    for c in "stmd":
        table[ord(c)] = STMD
    for c, kind in (("r", R), ("v", V), ("e", E), ("l", L)):
        table[ord(c)] = kind
    table[SEP_CP] = END
    return table


@lru_cache(1)
def transitions() -> np.ndarray:
    """Next state, premultiplied by CLASSES, at [state * CLASSES + class]."""
    t = np.zeros((STATES, CLASSES), np.uint8)
    t[:, OTHER], t[:, DIGIT], t[:, BLANK], t[:, SPACE], t[:, END] = IN_OTHER, IN_DIGITS, AT_BLANK, AT_SPACE, BEGIN
    for c in (LETTER, STMD, R, V, E, L):
        t[:, c] = IN_LETTERS
    # An apostrophe starts a piece unless a blank or other signs before it take it in.
    t[:, APOS] = AT_APOS
    t[[AT_BLANK, IN_OTHER, AT_APOS], APOS] = IN_OTHER
    t[AT_APOS, STMD], t[AT_APOS, R], t[AT_APOS, V], t[AT_APOS, L] = DONE2, APOS_R, APOS_V, APOS_L
    t[APOS_R, E] = t[APOS_V, E] = t[APOS_L, L] = DONE3
    return (t.astype(np.int64) * CLASSES).reshape(-1)


def scan_states(classes: np.ndarray) -> np.ndarray:
    """The automaton's state after every character, by composing block functions."""
    step, n = transitions(), len(classes)
    rows = -(-n // BLOCK)
    padded = np.full(rows * BLOCK, END, np.uint8)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    # Pass 1: the function of each block. Most become constant within a few characters; ``guess``
    # follows one entry state, and ``table`` all of them for the blocks that still depend on it.
    guess = np.zeros(rows, np.int64)
    live, table = np.arange(rows), np.repeat((np.arange(STATES) * CLASSES)[:, None], rows, axis=1)
    for j in range(BLOCK):
        guess = step[guess + columns[j]]
        if len(live):
            table = step[table + columns[j][live]]
            if j % 8 == 7:
                open_ = (table != table[0]).any(axis=0)
                live, table = live[open_], table[:, open_]
    # Chain the functions over the blocks.
    entry = np.zeros(rows, np.int64)
    entry[1:] = guess[:-1]
    for at, row in enumerate(live):
        if row + 1 < rows:
            entry[row + 1] = table[entry[row] // CLASSES, at]
    # Pass 2: all states, from the true entry states.
    states, now = np.empty((BLOCK, rows), np.uint8), entry
    for j in range(BLOCK):
        now = step[now + columns[j]]
        states[j] = now // CLASSES
    return states.T.reshape(-1)[:n]


_KIND = np.array([5, 1, 2, 3, 4, 5, 1, 1, 1, 1, 1, 0], np.uint8)     # by class; 0 ends a text


def piece_offsets(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts; byte offsets of their pieces (and the end); pieces before each text."""
    joined = SEP + SEP.join(texts) + SEP
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = class_table()[points]
    states = scan_states(classes)
    kind = _KIND[classes]
    before, after = np.zeros_like(kind), np.zeros_like(kind)
    before[1:], after[:-1] = kind[:-1], kind[1:]
    space, space_before = (kind == 3) | (kind == 4), (before == 3) | (before == 4)
    cut = ~space & ((before == 0) | (before == 4) | (~space_before & (kind != before)))
    two, three = states == DONE2, np.flatnonzero(states == DONE3)
    cut[two] = cut[three] = cut[three - 1] = False
    done = np.flatnonzero(two | (states == DONE3)) + 1
    cut[done] = True
    cut |= space & (~space_before | ((after != 0) & (after != 3) & (after != 4)))
    cut &= kind != 0
    width = 1 + (points >= 0x80).astype(np.uint8) + (points >= 0x800) + (points >= 0x10000)
    ends = np.flatnonzero(points == SEP_CP)
    width[ends] = 0
    at = np.flatnonzero(cut)
    data = "".join(texts).encode()
    return data, np.append((np.cumsum(width, dtype=np.int64) - width)[at], len(data)), np.searchsorted(at, ends)


class PieceCache:
    """Ids of pieces, merged once each; ``merge`` takes a list of pieces and gives their id lists."""

    def __init__(self, merge: Callable[[list[bytes]], list[list[int]]]):
        self.merge = merge
        self.kept: dict[bytes, list[int]] = {}

    def ids_of(self, pieces: list[bytes]) -> list[list[int]]:
        found = list(map(self.kept.get, pieces))
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, self.merge([pieces[i] for i in new])):
            found[i] = ids
            if len(self.kept) < MAX_CACHED:         # the frequent pieces come early and stay
                self.kept[pieces[i]] = ids
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids; ids before each text (and in all); piece offsets in bytes; pieces before each text."""
        data, offsets, first = piece_offsets(texts)
        if len(offsets) == 1:
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64), offsets, first
        # The slices as one Arrow column over the bytes; each distinct slice is looked up once.
        slices = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = slices.dictionary_encode()
        number = coded.indices.to_numpy()
        lists = self.ids_of(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum()))
        size = sizes[number]
        upto = np.concatenate([[0], np.cumsum(size)])
        where = np.repeat((np.cumsum(sizes) - sizes)[number] - upto[:-1], size)
        where += np.arange(upto[-1])
        return flat[where], upto[first], offsets, first


def in_slices(texts: list[str], chars: int = CHARS_AT_ONCE) -> Iterator[tuple[int, list[str]]]:
    """Consecutive slices of about ``chars`` characters, each with its first index."""
    a, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            yield a, texts[a : i + 1]
            a, held = i + 1, 0
    if a < len(texts):
        yield a, texts[a:]


@lru_cache(4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(4)
def rank_cache(path: str, pattern: str) -> PieceCache:
    """A piece cache over the library's merge of one piece."""
    import tiktoken

    merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})._core_bpe.encode_single_piece
    return PieceCache(lambda pieces: [merge(p) for p in pieces])


@lru_cache(1)
def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free letter."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class ModelCache(PieceCache):
    """A piece cache over the tokenizers library's byte-level BPE model. With ``added``, as the library's default
    is, the tokenizer's added tokens are found first, leftmost and longest, and the scan runs on what lies between
    them; without, they are text like any other (the library's ``encode_special_tokens``)."""

    def __init__(self, path: str):
        self.library, letters = tokenizer(path), byte_letters()
        merge = self.library.model.tokenize
        super().__init__(lambda pieces: [[t.id for t in merge(p.decode("latin-1").translate(letters))] for p in pieces])
        added = self.library.get_added_tokens_decoder()
        self.added = {t.content: i for i, t in added.items() if t.content}
        #: Do all added tokens match as plain text?
        self.plain = not any(t.single_word or t.lstrip or t.rstrip for t in added.values())
        self.find = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def ids(self, texts: list[str], added: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """All ids; ids before each text (and in all)."""
        holds = [added and any(c in t for c in self.added) for t in texts]
        if not any(holds):
            return self.encode(texts)[:2]
        # Parts of all texts: plain ones and, between them, added tokens (the odd ones of each text).
        parts = [(self.find.split(t) if self.plain else [""]) if h else [t] for t, h in zip(texts, holds)]
        flat, upto = self.encode([x for some in parts for x in some[::2]])[:2]
        out, sizes, at = [], [], 0
        for text, h, some in zip(texts, holds, parts):
            found = []
            for j, x in enumerate(some):
                if j % 2:
                    found.append(np.array([self.added[x]], np.uint32))
                else:
                    found.append(flat[upto[at]:upto[at + 1]])
                    at += 1
            if h and not self.plain:
                found = [np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)]
            out += found
            sizes.append(sum(map(len, found)))
        return np.concatenate(out), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


@lru_cache(2)
def model_cache(path: str) -> ModelCache:
    return ModelCache(path)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids array<int>, offsets array<int>`` (byte offset of each piece) for every row."""
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = rank_cache(path, pattern)
        for batch in batches:
            keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, some in in_slices(texts):
                ids, upto, offsets, first = cache.encode(some)
                starts = offsets[:-1] - np.repeat(offsets[first[:-1]], np.diff(first))
                yield pa.RecordBatch.from_arrays([
                    keys.slice(a, len(some)),
                    pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(starts.astype(np.int32)))], names=["k", "ids", "offsets"])

    kind = dict(docs.dtypes)[key]
    d = docs.selectExpr(f"`{key}` AS k", f"`{text}` AS t")
    return d.mapInArrow(run, f"k {kind}, ids array<int>, offsets array<int>").withColumnRenamed("k", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``encoded`` rows with the column ``decoded`` (binary): the bytes that the ids stand for."""
    python_ready(encoded.sparkSession)
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = {i: b for b, i in ranks(path).items()}.__getitem__
        at = names.index(ids)
        for batch in batches:
            made = [b"".join(map(word, row.values.to_numpy(zero_copy_only=False).tolist())) for row in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*names, "decoded"])

    fields = ", ".join(f"`{c}` {kind}" for c, kind in encoded.dtypes)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")
