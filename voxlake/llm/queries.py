"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm import (bpe_scan, elias_fano, jaccard_rtree, langid_nb, license_rules, merkle_pivot, packing_dp, pii_boost, quality_mcd, spelling_gram,
                         toxic_ftrl, url_rules, vptree)
from voxlake.llm.common import lower_az, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mcd.rules(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_boost.find(table(spark, sf_dir, "documents"))


def op3_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid_nb.train(docs.where(~langid_nb.held_out()))
    # The fold is a function of doc_id alone, which no prediction sees.
    return langid_nb.predict(docs, model).withColumn("held_out", langid_nb.held_out()).select(
        "doc_id", "held_out", "lang_pred", "score", "margin")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_scan.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe_scan.decode(encoded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), F.size("offsets").cast("long").alias("n_pieces"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_dp.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True)


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = elias_fano.write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True)
    return elias_fano.read_shards(manifest)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rules_frame(spark))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_rtree.linked(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = {"text": F.when(third, lower_az(F.col("text"))).otherwise(F.col("text"))}
    proofs = merkle_pivot.build(table(spark, sf_dir, "documents"), received=tampered).proofs()
    return proofs.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle_pivot.proof_digest().alias("proof_sha256"),
                         merkle_pivot.folded().alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxic_ftrl.train(docs, table(spark, sf_dir, "labels"), ~toxic_ftrl.held_out())
    # The fold is a function of doc_id alone, which no score sees.
    return toxic_ftrl.score(docs, model).select("doc_id", toxic_ftrl.held_out().alias("held_out"), "score", "predicted")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_gram.variants(table(spark, sf_dir, "documents"))


QUERIES = {"op1_quality": op1_quality, "op2_pii": op2_pii, "op3_vptree": op3_vptree, "op4_langid": op4_langid, "op5_bpe": op5_bpe, "op6_packing": op6_packing, "op7_url_filter": op7_url_filter,
           "op8_token_shards": op8_token_shards, "op9_jaccard": op9_jaccard, "op10_license": op10_license, "op11_merkle": op11_merkle,
           "op12_toxicity": op12_toxicity, "op13_spelling": op13_spelling}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _url_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}', {t})" for t, some in ((0, url_rules.BASE_RULES), (1, url_rules.OWN_RULES)) for h, p, v in some)
    return f"""WITH r AS (SELECT *, host || path AS name FROM (VALUES {rules}) t(host, path, verdict, tier)),
u AS (SELECT row_number() OVER () AS n, page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
hit AS (SELECT u.n, r.name, r.verdict, r.tier, row_number() OVER (PARTITION BY u.n
          ORDER BY r.tier, length(r.name) DESC, r.verdict DESC, r.name DESC) AS k
        FROM u JOIN r ON (u.host = r.host OR suffix(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT u.page_id, u.host, u.path, CASE WHEN h.tier = 0 THEN h.name END AS rule, coalesce(h.verdict, 'allow') AS verdict,
       CASE WHEN h.tier = 1 THEN h.name END AS own_rule
FROM u LEFT JOIN (SELECT * FROM hit WHERE k = 1) h USING (n)"""


def _jaccard_sql(share: int, whole: int) -> str:
    return f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(ws) >= 3 THEN [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)]
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE {whole} * c >= {share} * (nx.n + ny.n - c)),
r AS (SELECT doc_id, doc_id AS m FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.m = e.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, l.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(m) AS component_id FROM r GROUP BY doc_id) l USING (doc_id)"""


# CRC-32 of UTF-8 text: the table by its polynomial, then one step for each byte.
_CRC = """tab AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc)"""


def _crc(text: str) -> str:
    """SQL: the unsigned CRC-32 of ``text`` (``tab`` must be joined)."""
    code = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || hex(encode({text}))[2 * i + 1 : 2 * i + 2] AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {code}), lambda c, x: xor(c >> 8, tab.crc[(xor(c, x) & 255) + 1])), 4294967295)"


def _merkle_sql(part_levels: int = 8, over_levels: int = 4, fan: int = 8) -> str:
    def enc(value: str) -> str:
        return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value}, '-')"

    def hashed(text: str) -> str:
        return "sha256(" + " || ".join(map(enc, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    tampered = f"CASE WHEN {_crc('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END"
    steps = [f"leaf AS (SELECT doc_id, coalesce('1' || lang, '0') AS g, {hashed('text')} AS h, {hashed('t2')} AS claim FROM (SELECT *, {tampered} AS t2 FROM documents, tab))"]

    def tree(name: str, below: str, n: int) -> None:
        """Levels ``name``0 to ``name``n over rows (g, pos, h): with ``total``, and a parent's hash where there are more than one."""
        steps.append(f"{name}0 AS (SELECT g, pos, h, count(*) OVER (PARTITION BY g) AS total FROM {below})")
        for k in range(1, n + 1):
            steps.append(f"""{name}{k} AS (SELECT g, pos // {fan} AS pos, CASE WHEN any_value(total) = 1 THEN any_value(h)
                ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h, CAST(ceil(any_value(total) / {fan}.0) AS BIGINT) AS total FROM {name}{k - 1} GROUP BY g, pos // {fan})""")

    def walk(frm: str, name: str, n: int) -> str:
        """Adds each level's siblings to ``proof`` and folds ``fold``, from rows with (g, pos)."""
        for k in range(n):
            to = f"{frm}{name}{k}"
            steps.append(f"""{to} AS (SELECT * EXCLUDE (l, r, total) REPLACE (proof || l || r AS proof, CASE WHEN total = 1 THEN fold ELSE sha256(l || fold || r) END AS fold,
                pos // {fan} AS pos) FROM (SELECT w.*, n.l, n.r, n.total FROM {frm if not k else f'{frm}{name}{k - 1}'} w JOIN (SELECT g AS ng, pos AS npos, total,
                coalesce(string_agg(h, '') OVER (PARTITION BY g, pos // {fan} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(h, '') OVER (PARTITION BY g, pos // {fan} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
                FROM {name}{k}) n ON w.g = n.ng AND w.pos = n.npos))""")
        return f"{frm}{name}{n - 1}"

    steps.append("placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaf)")
    tree("p", "placed", part_levels)
    steps.append(f"tops AS (SELECT '' AS g, g AS part, h, row_number() OVER (ORDER BY encode(g)) - 1 AS pos FROM p{part_levels})")
    tree("o", "tops", over_levels)
    steps.append("walk AS (SELECT doc_id, h AS leaf, g, pos, '' AS proof, claim AS fold FROM placed)")
    inner = walk("walk", "p", part_levels)
    steps.append(f"mid AS (SELECT w.doc_id, w.leaf, t.h AS subroot, '' AS g, t.pos, w.proof, w.fold FROM {inner} w JOIN tops t ON t.part = w.g)")
    outer = walk("mid", "o", over_levels)
    return f"""WITH {_CRC}, {', '.join(steps)}
SELECT w.doc_id, w.leaf, w.subroot, o.h AS root, sha256(w.proof) AS proof_sha256, w.fold AS folded_root, w.fold = o.h AS verified FROM {outer} w, o{over_levels} o"""


def _spelling_sql() -> str:
    run = "[A-Za-z\\x{00C0}-\\x{00FF}]+"
    return f"""WITH RECURSIVE {_CRC},
occ AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '{run}')), '{UPPER}', '{LOWER}') AS w FROM documents),
r AS (SELECT id, w, count(*) AS n FROM occ WHERE length(w) >= 7 GROUP BY ALL),
c AS (SELECT w, n, {_crc("(id || ':' || w)")} AS h FROM r, tab),
v AS (SELECT CASE WHEN h % 31 = 0 THEN w[1 : h % length(w)] || w[h % length(w) + 2 :] ELSE w END AS word, n FROM c),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM v WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word AS x, b.word AS y, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT x, y, n, count(*) OVER (PARTITION BY x) AS n_near, row_number() OVER (PARTITION BY x ORDER BY n DESC, encode(y)) AS k FROM pairs),
f AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n >= 10 * w.n THEN b.y END AS form, CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n
    FROM words w LEFT JOIN best b ON b.x = w.word AND b.k = 1),
chain AS (SELECT word, word AS cur, 0 AS d FROM f UNION ALL SELECT chain.word, f.form, d + 1 FROM chain JOIN f ON f.word = chain.cur WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(cur, d) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM f JOIN ends e USING (word)"""


# The other operators learn, estimate, search trees, encode or optimise; SQL has no form for them, and
# tests hold them against brute force, round trips or held-out rows.
ORACLE_SQL = {"op7_url_filter": _url_sql(), "op9_jaccard": _jaccard_sql(90, 100), "op11_merkle": _merkle_sql(), "op13_spelling": _spelling_sql()}
