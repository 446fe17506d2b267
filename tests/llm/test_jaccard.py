"""N-gram Jaccard join against brute force, in its several regimes."""

import random
import re

import numpy as np
import pytest

from voxlake.llm import jaccard_rtree as J

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(texts, width):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        out.append(frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    return out


def brute(rows, width, share):
    """doc_id -> (sizes, component) by comparing every pair."""
    sets = sets_of([t for _, t in rows], width)
    up = {k: k for k, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= share * len(a | b):
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                up[y] = x
    return sorted((k, len(s), find(k)) for (k, _), s in zip(rows, sets))


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(22):
        base = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 4, 6, 9, 14, 25, 60, 150]))]
        for _ in range(rng.choice([1, 2, 4, 20])):
            copy = base[:]
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
        texts += [" ".join(base[:-k]) for k in (1, 3) if len(base) > 20]
    rng.shuffle(texts)
    return list(enumerate([*texts, "", None, " \n", "A b C", "a B c", "é É x", "É é x"]))


@pytest.mark.parametrize("width,share,tile", [(3, 90, 2048), (5, 80, 2048), (3, 90, 6), (2, 50, 6)])
def test_components_like_brute_force(spark, monkeypatch, width, share, tile):
    """Whole blocks, and blocks cut into tiles."""
    monkeypatch.setattr(J, "TILE", tile)
    rows = corpus(width * share)
    df = spark.createDataFrame([(*r, "z", 0) for r in rows], "doc_id long, text string, id string, class long").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.linked(df, width, share).collect())
    assert got == brute(rows, width, share)


def test_keys_agree_for_every_linked_pair():
    """The blocking is lossless: sets that link share a key, whatever their size."""
    rng = np.random.default_rng(5)
    for share in (50, 80, 90):
        for n in (2, 3, 5, 8, 13, 21, 40, 100, 400):
            for _ in range(30):
                a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
                drop = rng.integers(0, n + 1)
                b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, rng.integers(0, n + 1)).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if len(b) and 100 * both >= share * (len(a) + len(b) - both) and len(a) + len(b) != 2 * both:
                    keys, owner = J.block_keys([a, b], share, 100)
                    assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist()), (share, n)


def test_rtree_finds_every_pair_the_bound_allows():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 4, (300, J.DIMS)).astype(np.int32)
    counts[150:] = counts[:150] + (rng.random((150, J.DIMS)) < 0.3)
    block = np.tile(rng.integers(0, 3, 150), 2)
    order = np.argsort(block, kind="stable")
    counts, block = counts[order], block[order]
    size = counts.sum(axis=1).astype(np.int64)
    label = np.arange(300)
    hub = np.ones(300, bool)
    got = {(i, j) for x, y in J.rtree_pairs(block, size, counts, label, hub, 80, 100) for i, j in zip(x.tolist(), y.tolist())}
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if block[i] == block[j]
            and 180 * np.minimum(counts[i], counts[j]).sum() >= 80 * (size[i] + size[j])
            and 100 * size[i] >= 80 * size[j] and 100 * size[j] >= 80 * size[i]}
    assert got == want and want


def test_repeated_and_null_ids(spark):
    """Rows that repeat an id join their texts' groups; a null id gets its copies' group."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (2, a), (2, b), (3, b), (None, b), (None, "alone here now"), (7, a), (7, a), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in J.linked(df).collect()}
    assert got == {(1, 38): 1, (2, 38): 1, (3, 38): 1, (None, 38): 1, (None, 1): None, (7, 38): 1, (8, 0): 8}
    kept = J.one_of_each(df.selectExpr("*", "5 AS jaccard_id", "'x' AS label"), 3, 90, 100)
    assert kept.columns == ["doc_id", "text", "jaccard_id", "label"]
    # Text b of id 2 is not text a of id 2: it links to no smaller id, so it stays and 3 goes.
    assert sorted(repr(r.doc_id) for r in kept.collect()) == ["1", "2", "8", "None", "None"]
    assert [r.text for r in kept.where("doc_id = 2").collect()] == [b]
    twice = spark.createDataFrame([(4, "x y z w"), (4, "x y z w"), (5, "p q r s")], "doc_id long, text string")
    assert sorted(r.doc_id for r in J.one_of_each(twice, 3, 90, 100).collect()) == [4, 5]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.linked(df).count() == 0 and J.one_of_each(df, 5, 80, 100).count() == 0


def test_each_text_of_a_repeated_id_is_judged_by_itself(spark):
    """Two unrelated texts under one id: the one that copies a smaller id goes, the other stays; equal rows become one."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (5, b), (7, b), (8, c), (8, None), (None, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in J.one_of_each(df, 5, 80, 100).collect()]
    assert sorted(got, key=repr) == sorted([(3, a), (5, b), (8, c), (8, None), (None, c)], key=repr)


def test_keys_agree_under_any_ranks():
    """The tally only orders the shingles: whatever it says, linked sets share a key."""
    rng = np.random.default_rng(6)
    for share in (50, 80, 90):
        for n in (2, 4, 5, 9, 10, 37, 200):
            for _ in range(20):
                ranks = rng.integers(0, 256, J.SLOTS).astype(np.uint8)
                a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
                b = np.unique(np.concatenate([a[rng.integers(0, n + 1):], rng.integers(0, 1 << 63, rng.integers(0, n + 1)).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if len(b) and 100 * both >= share * (len(a) + len(b) - both) and len(a) + len(b) != 2 * both:
                    keys, owner = J.block_keys([a, b], share, 100, ranks)
                    assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist()), (share, n)


def test_a_passage_that_many_texts_share_makes_no_block(spark):
    """Unrelated texts around one passage meet in no block; two near copies among them do."""
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [f"{' '.join(f'x{k}_{i}' for i in range(50))} {passage}" for k in range(120)]
    texts.append(texts[7].replace("x7_20 ", "other "))
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").repartition(3)
    J.python_ready(spark)
    names = {J.class_of(s) for s in J.shingle_sets([texts[7], texts[120]], 5)}
    assert {r["class"] for r in J.blocks(df, 5, 80, 100, 4).collect()} == names
    linked = J.linked(df, 5, 80, 100, "id", "t")
    assert {r.id: r.component_id for r in linked.collect()} == {k: k for k in range(120)} | {120: 7}


def test_tally_counts_every_row(spark):
    """Each slot's byte is the logarithm of its hits over all tasks, repeated rows and nulls included."""
    texts = ["a b c d", "a b c d", "b c d e f", "", None, "x"] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").repartition(4)
    J.python_ready(spark)
    hits = np.bincount(J.slots_of(np.concatenate(J.shingle_sets([t or "" for t in texts], 3))), minlength=J.SLOTS)
    assert J.tally(df, 3).tolist() == (np.log2(hits + 1) * 8).astype(np.uint8).tolist()


def test_linked_sets_meet_by_size_and_early_keys():
    """Whatever the ranks, linked sets lie in one block; sets too far apart in size do not, whatever keys they share."""
    rng = np.random.default_rng(7)
    gap, seen = J.level_gap(80, 100), 0
    for n in (4, 5, 9, 10, 37, 200, 3000):
        for _ in range(20):
            ranks = rng.integers(0, 256, J.SLOTS).astype(np.uint8)
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            b = np.unique(np.concatenate([a[rng.integers(0, n // 4 + 1):], rng.integers(0, 1 << 63, rng.integers(0, n // 4 + 1)).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            keys, owner, early = J.prefix_keys([a, b], 80, 100, ranks)
            levels = J.size_levels(np.array([len(a), len(b)]))
            classes, size = J.meeting(keys, owner, levels[owner], early, gap)
            if 100 * both >= 80 * (len(a) + len(b) - both) and len(a) + len(b) != 2 * both:
                seen += 1
                assert {0, 1} in [set(v.tolist()) for v in np.split(classes, np.cumsum(size)[:-1])], n
    assert seen > 40
    key, two = np.array([5, 5], np.uint64), np.array([1, 2])
    assert J.meeting(key, two, J.size_levels(np.array([40, 200])), np.array([True, True]), gap)[1].tolist() == []
    assert J.meeting(key, two, J.size_levels(np.array([40, 44])), np.array([False, True]), gap)[1].tolist() == []
    assert J.meeting(key, two, J.size_levels(np.array([40, 44])), np.array([True, False]), gap)[0].tolist() == [1, 2]


def test_stored_vectors_tell_long_texts_apart():
    """Unrelated sets of many shingles are refused before their texts travel; sets that link never are."""
    rng = np.random.default_rng(8)
    for n in (300, 1023, 1024, 20_000, 60_000):
        a, b = (np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for _ in "ab")
        near = np.unique(np.concatenate([a[n // 10:], b[: n // 10]]))
        va, vb, vn = (J.unpacked(J.packed(J.counts_of(s, J.dim_bits(len(s)))), len(s)) for s in (a, b, near))
        assert J.folded(va, J.DIM_BITS).tolist() == J.counts_of(a).tolist()
        assert not J.may_link(va, vb, len(a) + len(b), 80, 100) and J.may_link(va, vn, len(a) + len(near), 80, 100)
    assert J.unpacked(J.packed(J.counts_of(np.full(2000, 7, np.uint64), 9)), 2000).max() == 2000


def test_a_chain_of_unrelated_stars_is_dealt_in_proportion(spark, monkeypatch):
    """Stars that hang together by one class each are one family with many heads: each pair of a star still meets, and
    the copies of classes follow the stars, not the square of the family."""
    monkeypatch.setattr(J, "TILE", 6)
    rows = [(1, c, c > 0, c, c, 30) for c in range(3)] + [(s, c, c != 0, c, c, 30) for s in range(2, 301) for c in (0, 3 * s, 3 * s + 1)]
    members = spark.createDataFrame(rows, "star long, class long, head boolean, id long, label long, n long").repartition(3)
    got = J.dealt(members, 4).collect()
    at = {}
    for r in got:
        at.setdefault((r.block, r["class"]), set()).add(r.bucket)
    for star, c, head, *_ in rows:
        if head:
            assert all(at[star, c] & at[star, other] for s, other, *_ in rows if s == star)
    assert len(got) <= 2 * len(rows), len(got)


def test_long_texts_hold_more_keys_than_a_byte_counts(spark):
    """A class with hundreds of keys in a bucket meets its near copy; sizes and early keys arrive with the keys."""
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(words), " ".join(words[:1990] + ["x"] + words[1991:]), " ".join(f"y{i}" for i in range(500))]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").repartition(2)
    J.python_ready(spark)
    names = {J.class_of(s) for s in J.shingle_sets(texts[:2], 5)}
    for rare in (True, False):
        assert {r["class"] for r in J.blocks(df, 5, 80, 100, 1, rare).collect()} == names


def test_tally_sums_over_groups_of_tasks(spark, monkeypatch):
    monkeypatch.setattr(J, "TASKS", 2)
    texts = [f"a b c d{i % 7}" for i in range(700)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").repartition(9)
    J.python_ready(spark)
    hits = np.bincount(J.slots_of(np.concatenate(J.shingle_sets(texts, 3))), minlength=J.SLOTS)
    assert J.tally(df, 3).tolist() == (np.log2(hits + 1) * 8).astype(np.uint8).tolist()
