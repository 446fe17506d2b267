"""The Merkle manifest, toxicity and spelling variants."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.llm import merkle_pivot, spelling_gram, toxic_ftrl
from voxlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, source string, lang string, n_chars long, text string"


# -- manifest ------------------------------------------------------------------------------------------

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    tree = [nodes]
    while len(tree[-1]) > 1:
        tree.append([digest("".join(tree[-1][i:i + 8])) for i in range(0, len(tree[-1]), 8)])
    return tree


def plain_manifest(rows, claims):
    parts = collections.defaultdict(list)
    for row, claim in zip(rows, claims):
        parts[row[2]].append((row[0], plain_leaf(row), plain_leaf(claim)))
    names = sorted(parts, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        parts[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [plain_tree([x[1] for x in parts[g]]) for g in names]
    over = plain_tree([t[-1][0] for t in trees])
    out = []
    for at, g in enumerate(names):
        for i, (key, own, claim) in enumerate(parts[g]):
            proof, h = "", claim
            for tree, k in ((trees[at], i), (over, at)):
                for level in tree[:-1]:
                    run, slot = level[k // 8 * 8:k // 8 * 8 + 8], k % 8
                    left, right = "".join(run[:slot]), "".join(run[slot + 1:])
                    proof, h, k = proof + left + right, digest(left + h + right), k // 8
            out.append((key, own, trees[at][-1][0], over[-1][0], digest(proof), h, h == over[-1][0]))
    return sorted(out, key=repr)


ODD = [(1, None, None, None, None), (None, "s", "a", 1, "X"), (None, "s", "a", 1, "X"), (2, "s", "b", 1, ""), (2, "s", "b", 1, "Yé😀")]
MANY = [(i, "s", "c", i, f"T{i}") for i in range(521)] + [(i, "s", f"l{i:02d}", i, f"T{i}") for i in range(70)] + [(9, "s", "", 9, "same")] * 20


@pytest.mark.parametrize("rows", [[], ODD[:1], ODD, ODD + MANY, [(i, "s", "x", 0, "t" * 30000 * (i == 3)) for i in range(8)]], ids=["empty", "one", "odd", "many", "eight"])
def test_manifest_like_plain_trees(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).withColumn("leaf", F.lit(1)).withColumn("g", F.lit("clash")).withColumn("pos", F.lit(0))
    found = merkle_pivot.build(docs.repartition(5), received={"text": F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))})
    p = found.proofs().select("id", "leaf", "subroot", "root", merkle_pivot.proof_digest().alias("p"), merkle_pivot.folded().alias("f"))
    got = sorted((tuple(r) + (r.f == r.root,) for r in p.collect()), key=repr)
    claims = [(*r[:4], r[4].lower()) if r[0] is not None and r[0] % 3 == 0 and r[4] is not None else r for r in rows]
    assert got == plain_manifest(rows, claims)
    assert found.root() == (got[0][3] if got else None)


def test_any_changed_field_is_seen(spark):
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(30)]
    docs = spark.createDataFrame(rows, DOCS)
    for name, value in (("source", F.lit(None).cast("string")), ("n_chars", F.col("n_chars") + 1), ("text", F.concat("text", F.lit(" ")))):
        p = merkle_pivot.build(docs, received={name: F.when(F.col("doc_id") == 7, value).otherwise(F.col(name))}).proofs()
        assert [r.id for r in p.where(merkle_pivot.folded() != F.col("root")).collect()] == [7]


# -- toxicity ------------------------------------------------------------------------------------------

def test_word_hashes_like_python():
    texts = ["Idiot, idiot! ab_c d9\nÉÈ straße ΑΣ", "", " ", "x", "foolish foolishly"]
    (h, *stems), of = toxic_ftrl.word_hashes(texts)
    words = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"\w+", t.lower())]
    assert of.tolist() == [i for i, _ in words]
    assert len(set(h.tolist())) == len({w for _, w in words}) == len(set(zip(h.tolist(), (w for _, w in words))))
    for n, stem in zip(toxic_ftrl.STEMS, stems):
        assert [x > 0 for x in stem.tolist()] == [len(w) > n for _, w in words]
        assert len({s for s in stem.tolist() if s}) == len({w[:n] for _, w in words if len(w) > n})


def test_grams_are_words_neighbours_and_skips():
    (h, *_), _ = toxic_ftrl.word_hashes(["a b c", "d"])
    bucket, of = toxic_ftrl.grams(["a b c", "d"])
    assert np.bincount(of).tolist() == [3 + 2 + 1, 1]       # no pair goes over a text's end
    assert set(toxic_ftrl.grams(["a x c"])[0]) & set(bucket[of == 0]) == set(toxic_ftrl.grams(["a"])[0]) | set(toxic_ftrl.grams(["c"])[0]) | {bucket[of == 0][-1]}


def test_learner_like_the_update_rule():
    """Per-coordinate rates and L1 by the formulas, one coordinate at a time."""
    rng = np.random.default_rng(1)
    learner, z, n = toxic_ftrl.Ftrl(), collections.Counter(), collections.Counter()
    alpha, beta, l1 = toxic_ftrl.ALPHA, toxic_ftrl.BETA, toxic_ftrl.L1

    def weight(i):
        lam = 0.0 if i == toxic_ftrl.BUCKETS else l1
        return 0.0 if abs(z[i]) <= lam else -(z[i] - np.sign(z[i]) * lam) * alpha / (beta + n[i] ** 0.5)

    for _ in range(300):
        at, y = np.append(np.flatnonzero(rng.random(12) < 0.4), toxic_ftrl.BUCKETS), float(rng.random() < 0.5)
        learner.learn(at, y, 3.0)
        w = {int(i): weight(int(i)) for i in at}
        g = 3.0 * (1 / (1 + np.exp(-sum(w.values()))) - y)
        for i in w:
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w[i]
            n[i] += g * g
    m = learner.model()
    assert np.allclose([weight(int(i)) for i in m.buckets], m.weights) and m.bias == pytest.approx(weight(toxic_ftrl.BUCKETS))
    assert all(weight(i) == 0 for i in range(12) if i not in set(m.buckets.tolist()))


def test_held_out_toxicity(spark):
    """On rows that the fit does not see: most toxic ones found, clean ones left alone."""
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op12_toxicity"](spark, sf).collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in rows.items())
    out = [(r.toxic, rows[r.doc_id].predicted) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r.doc_id].held_out]
    toxic, clean = [p for t, p in out if t], [p for t, p in out if not t]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.01


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(i, f"you are a {'dreadful fool' if i % 2 else 'kind person'} number {i}", 0.5) for i in range(400)]
                                 + [(900, None, 0.5), (901, "", 0.5), (901, " \n", 0.5), (None, "dreadful fool", 0.5), (902, "kind person " * 40000, 0.5)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1), (900, None)], "doc_id long, toxic int")
    m = toxic_ftrl.train(docs, labels, F.lit(True))
    got = collections.defaultdict(list)
    for r in toxic_ftrl.score(docs, m).collect():
        got[r.doc_id].append(r)
    assert sum(len(v) for v in got.values()) == docs.count()
    assert all(got[i][0].predicted == i % 2 for i in range(400)) and got[None][0].predicted == 1 and got[902][0].predicted == 0
    assert len({r.score for i in (900, 901) for r in got[i]}) == 1
    assert len(m.buckets) < 100      # the L1 term leaves out the numbers
    for other in (labels.limit(0), labels.where("toxic = 0")):
        none = toxic_ftrl.train(docs, other, F.lit(True))
        assert {r.score for r in toxic_ftrl.score(docs, none).collect()} == {0.0}
    assert toxic_ftrl.score(docs.limit(0), m).count() == 0


# -- spelling variants ------------------------------------------------------------------------------------

def plain_words(rows):
    n = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += len(w) >= 7
    return {w: c for w, c in n.items() if c >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows):
    n = plain_words(rows)
    near = {w: [v for v in n if v != w and one_edit(w, v)] for w in n}
    best = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: v for w, v in best.items() if n[v] >= 10 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w
    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


def spelling_rows(seed):
    """Words of few letters and their edits, frequent and rare; long words; runs that a digit or a sign ends."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abÉé") for _ in range(rng.randint(7, 9))) for _ in range(6)] + ["a" * 70, "a" * 71, "ab" * 100, "ab" * 50 + "b" + "ab" * 50]
    rows = [(None, None), (1, ""), (2, "short word")]
    for i in range(300):
        w = list(rng.choice(stems))
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            at, c = rng.randrange(len(w)), rng.choice("abÉéÿ")
            w[at:at + rng.randint(0, 1)] = [c] * rng.randint(0, 1)
        rows.append((rng.choice([None, 3, i]), " ".join(["".join(w).upper() if i % 5 == 0 else "".join(w)] * rng.choice([1, 1, 2, 30])) + rng.choice([".", "1", "-x", ""])))
    return rows + rows[:40]


@pytest.mark.parametrize("tile, rows_at_once", [(384, 40000), (3, 7), (16, 1)])
def test_variants_like_brute_force(spark, monkeypatch, tile, rows_at_once):
    for name, value in (("TILE", tile), ("ROWS", rows_at_once)):
        monkeypatch.setattr(spelling_gram, name, value)
    rows = spelling_rows(tile)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(5))
    got = sorted(tuple(r) for r in spelling_gram.variants(docs).collect())
    want = plain_variants(rows)
    assert got == want and any(r[1] for r in got) and len({len(r[0]) for r in got}) > 5
    assert spelling_gram.variants(docs.limit(0)).count() == 0


def test_pairs_like_brute_force_in_one_group():
    """Tiles of one large group and canonical holes: each pair once, over all holes of a word."""
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(7, 9))) for _ in range(400)})
    found = collections.Counter()
    for base in (7, 8, 9):
        k = spelling_gram.holes(base)
        for hole in range(k):
            a, z = hole * base // k, (hole + 1) * base // k
            rows = sorted((hash((w[:a], w[z + len(w) - base:])), w) for w in words if len(w) in (base, base + 1))
            if rows:
                key = np.array([r[0] for r in rows])
                x, y = spelling_gram.near_pairs(key, np.full(len(rows), hole), np.full(len(rows), base), [r[1] for r in rows])
                found.update(tuple(sorted((rows[i][1], rows[j][1]))) for i, j in zip(x.tolist(), y.tolist()))
    want = {(a, b) for i, a in enumerate(words) for b in words[i + 1:] if one_edit(a, b)}
    assert set(found) == want and set(found.values()) == {1}


def test_chains_end_at_their_root(spark):
    chain = [f"w{i:02d}" for i in range(19)]
    forms = spark.createDataFrame(list(zip(chain, chain[1:])) + [(f"x{i}", "w07") for i in range(50)], "word string, form string")
    assert {r.root for r in spelling_gram.roots(forms).collect()} == {"w18"} and spelling_gram.roots(forms).count() == 68
    assert spelling_gram.roots(forms.limit(0)).count() == 0


def test_texts_are_searched_once(spark):
    plan = spelling_gram.words(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
