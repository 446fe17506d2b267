"""Tokens: pre-tokenisation scan, byte-level BPE, shards with Elias-Fano boundaries, packing."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from voxlake.llm import bpe_scan, elias_fano, packing_dp

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
ROWS = [(3, "It's 12 o'clock -- don't!  \n\n we'll see"), (1, None), (2, ""), (2, ""), (9, "a" * 3000), (None, "no id"),
        (5, "'" * 40 + " x" * 700 + "."), (4, "größe 中文 😀  <|endoftext|> \t end "), (9, "a" * 3000)]


@pytest.fixture
def docs(spark):
    """Extra columns have names that the operators use inside."""
    return spark.createDataFrame([(*r, 1, "x", 2.0) for r in ROWS], "doc_id long, text string, k long, t string, ids double").repartition(2)


def hf():
    tok = Tokenizer.from_file(JSON)
    tok.encode_special_tokens = True
    return tok


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="a tsrevlmd'  \n\t1½é中😀.! 　S\x1c", max_size=60), max_size=6))
def test_scan_cuts_like_the_pattern(texts):
    data, offsets, first = bpe_scan.piece_offsets(texts)
    pieces = [data[a:b] for a, b in zip(offsets, offsets[1:])]
    for i, t in enumerate(texts):
        assert pieces[first[i]:first[i + 1]] == [m.encode() for m in regex.findall(P.PATTERN, t)]


def test_scan_blocks_that_stay_open():
    """Runs whose block functions never become constant are chained through."""
    t = "'" * (3 * bpe_scan.BLOCK + 5) + "s"
    data, offsets, _ = bpe_scan.piece_offsets([t, t])
    want = [m.encode() for m in regex.findall(P.PATTERN, t)] * 2
    assert [data[a:b] for a, b in zip(offsets, offsets[1:])] == want


def test_encode_and_decode_like_the_library(spark, docs):
    lib = tiktoken.Encoding("x", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks={
        base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))})
    got = bpe_scan.decode(bpe_scan.encode(docs, RANKS, P.PATTERN), RANKS).collect()
    want = sorted((repr(k), lib.encode_ordinary(t or ""), (t or "").encode()) for k, t in ROWS)
    assert sorted((repr(r.doc_id), r.ids, bytes(r.decoded)) for r in got) == want
    for r in got:
        text = bytes(r.decoded)
        pieces = [text[a:b] for a, b in zip(r.offsets, [*r.offsets[1:], len(text)])]
        assert pieces == [m.encode() for m in regex.findall(P.PATTERN, text.decode())]
    assert bpe_scan.encode(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_small_cache_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(bpe_scan, "MAX_CACHED", 2)
    ids = bpe_scan.PieceCache(bpe_scan.rank_cache(RANKS, P.PATTERN).merge).encode(["one two three two one"])[0]
    assert ids.tolist() == bpe_scan.rank_cache(RANKS, P.PATTERN).encode(["one two three two one"])[0].tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "\n", "it's", "é😀", "a b", "12"]), max_size=8).map("".join), max_size=5))
def test_ids_like_the_library_at_its_default_setting(texts):
    """Added tokens are recognised; the library runs as the contract has it."""
    ids, upto = bpe_scan.model_cache(JSON).ids(texts)
    lib = Tokenizer.from_file(JSON)
    assert [ids[a:b].tolist() for a, b in zip(upto, upto[1:])] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano_select(steps):
    values = np.cumsum(np.array(steps, np.int64))
    ef = elias_fano.EliasFano.of(values)
    if len(values):
        assert ef.select(np.arange(len(values))).tolist() == values.tolist()
        assert ef.select(np.array([len(values) - 1])).tolist() == [values[-1]]
        assert len(ef.low) + len(ef.high) <= len(values) * (2 + np.log2(max(2, values[-1] / len(values)))) / 8 + 24


@pytest.mark.parametrize("per_file", [10, 4_000_000])
def test_shards_hold_the_ids_in_order(spark, docs, monkeypatch, per_file):
    monkeypatch.setattr(elias_fano, "IDS_PER_FILE", per_file)
    manifest = elias_fano.write_shards(docs, JSON)
    got = elias_fano.read_shards(manifest).collect()
    tok, at, want = hf(), 0, []
    ids = {t: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in ROWS}
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    for k, t in order:
        want.append((k, at, len(ids[t]), zlib.crc32(ids[t].tobytes())))
        at += len(ids[t])
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert elias_fano.read_shards(elias_fano.write_shards(docs.limit(0), JSON)).count() == 0
    with pytest.raises(ValueError):
        elias_fano.parse_shard(b"x" * 80)


def test_queries_recognise_added_tokens(spark, tmp_path):
    import corpus_pipeline
    from voxlake.llm.queries import op6_packing, op8_token_shards
    text = "a <|endoftext|> b"
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    ids = Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids
    shard, = op8_token_shards(spark, str(tmp_path)).collect()
    assert shard[2:] == (5, zlib.crc32(np.array([*ids, 2], "<u4").tobytes()))
    for r, in (op6_packing(spark, str(tmp_path)).collect(), corpus_pipeline.packing(spark, d, "").collect()):
        assert (r.doc_tokens, r.length, r.ids_crc32) == (5, 5, zlib.crc32(np.array([*ids, 0], "<u4").tobytes()))


def check_packing(rows, texts, size):
    tok = hf()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    lengths = []
    for some in by.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
        lengths.append(at)
    left = {}
    for t in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        left[(len(ids), zlib.crc32(ids.tobytes()))] = ids
    for r in rows:
        assert any(n == r.doc_tokens and zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
                   for (n, _), ids in left.items())
    assert sum(r.length for r in rows) == sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts)
    return sum(0 if n & (n - 1) == 0 else size - n for n in lengths) / (size * len(lengths))


@pytest.mark.parametrize("block", [50, 1_000_000])
def test_packing_tiles_every_document(spark, docs, block):
    rows = packing_dp.pack(docs, JSON, size=64, block=block).collect()
    assert check_packing(rows, [t for _, t in ROWS], 64) < 0.5
    assert packing_dp.pack(docs.limit(0), JSON).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.sampled_from([0.0, 2.0, 7.0])), min_size=1, max_size=40))
def test_cuts_are_the_cheapest(steps):
    size = 16
    at = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    penalty = np.array([0.0, *[p for _, p in steps[:-1]], 0.0])
    pad = lambda n: 0 if n & (n - 1) == 0 else size - n
    best = [0.0] + [1e9] * len(steps)
    for j in range(1, len(at)):
        best[j] = min(best[i] + pad(at[j] - at[i]) for i in range(j) if at[j] - at[i] <= size) + penalty[j] + packing_dp.EACH
    cuts = packing_dp.cheapest_cuts(at, penalty, size)
    by = dict(zip(at.tolist(), penalty.tolist()))
    cost = sum(pad(b - a) + packing_dp.EACH + by[b] for a, b in zip([0, *cuts.tolist()], cuts.tolist()))
    assert cost == pytest.approx(best[-1])


def test_padding_on_the_test_corpus(spark):
    """Little padding on real lengths: under 3 percent, with windows of 1024."""
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing_dp.pack(d, JSON).collect()
    by = {}
    for r in rows:
        by[r.sequence_id] = by.get(r.sequence_id, 0) + r.length
    pad = sum(0 if n & (n - 1) == 0 else 1024 - n for n in by.values())
    assert pad / (pad + sum(by.values())) < 0.03


def test_digest_query(spark):
    from voxlake.llm.queries import op5_bpe
    d = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in op5_bpe(spark, "/root/testdata/sf0.001").collect():
        assert r.decoded_sha256 == hashlib.sha256(d[r.doc_id].encode()).hexdigest()
