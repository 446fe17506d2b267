r"""Personal data: candidate spans, boosted trees and calibrated thresholds (native).

Base spans (email, ip, card, phone) are found by their patterns, leftmost and non-overlapping per kind,
and kept if they pass their check (octets, Luhn, digit counts); they are always redacted. Starts come from
the lengths, in code points, of the pieces between matches.

The method adds spans. High-recall generators propose further, overlapping candidates: ``number`` (long digit
groups), ``handle`` (spelled-out mail addresses, in any case, also with a plain dot) and ``secret`` (long runs
of letters and digits). A handle whose at-sign is bracketed passes its check and is added as it is; the trees
decide about the others. Each candidate of any kind has format features (length, digits, letters, separators,
distinct characters, upper case, the Luhn check but for cards, the octet check but for addresses, kind) and
context features (start of a line, a currency or unit after it, for base kinds an assignment sign before it).
Gradient-boosted trees (Spark ML) are fitted on a bounded sample of about ``SAMPLE`` candidates, drawn evenly
by kind and label (equal ones once) and labelled by strong evidence. Base kinds: a passed check is positive, a
failed check without a hint word before it negative. Other kinds: a hint word with an assignment sign is
positive, neither of them negative, so some true ones count as negative and the precision is estimated low. The
evidence (``e_hint``, ``e_assign``, the check) is left out of the features of each kind it labels, so the
trees must find the format, and find it also where the evidence is missing. Each kind's threshold is the smallest
score whose precision over all labelled candidates outside the fit reaches ``PRECISION``; without such a score
the kind adds nothing. The trees become one SQL expression that runs inside each row: no explode, no shuffle, no Python.

Regular expressions are written without nested backtracking (possessive loops, starts only where a run
starts), so one very long run of word characters or digits is scanned once.

Defined cases: a null text counts as empty (no spans, hash of the empty string); repeated rows give repeated
rows; without candidates, or with one label only, the trees add nothing; an empty table gives an empty
table; other columns of the input are ignored (``find``) or kept (``redacted``).
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import sql_str, written

# Kinds of the contract, in its order.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    # A local part that fails fails from every start within its run, so only run starts (or the end of
    # the last match) are tried; loops at the end of a pattern never give back.
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generators of the method.
EXTRA = {
    "number": r"(?<![A-Za-z0-9+.])[0-9](?:[\x20().-]{0,2}[0-9]){6,}+(?![A-Za-z0-9])",
    "handle": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)[a-z0-9-]{1,63}"
              r"(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20|\.)[a-z]{2,24}",
    "secret": r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_/+-]{0,63}[0-9])[A-Za-z0-9_+/-]{24,}+",
}
ALL = [*KINDS, *EXTRA]
HINT = (r"(?i)(?:mail|contact|reach|write|phone|tel|call|mobile|fax|card|visa|account|iban|ssn|passport|ip|host|address|"
        r"token|secret|key|password|passwd|pwd|auth)[a-z]{0,6}[\x20:=\"'#.-]{0,6}$")
ASSIGN = r"[:=][ \"']*$"
UNIT = (r"(?i)^\x20?(?:[%$€£¥°]|(?:usd|eur|euros?|gbp|chf|jpy|dollars?|percent|kg|mg|g|km|cm|mm|m|ml|l|kb|mb|gb|tb|ms|s|min|h|hz|kwh|mw|"
        r"bytes|days|hours|years|lines|rows|words|pages|items|pieces|times)(?![a-z0-9]))")
BEFORE, AFTER = 24, 12  # characters of context looked at before and after a candidate
SAMPLE = 20_000         # about the most rows that the trees are fitted on
DRAWS = 1_000_000       # steps of the share that is drawn for the fit
PRECISION = 0.9
TREES, DEPTH = 8, 3
SEED = 11
#: Fields of a candidate that the trees see.
FEATURES = ["f_len", "f_digits", "f_letters", "f_seps", "f_distinct", "f_upper", "f_luhn", "f_octets", "f_assign", "f_line", "f_unit", "f_kind"]
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def luhn(x: str) -> str:
    """SQL: do the digits of ``x`` pass the Luhn check (every second digit from the right doubled)?"""
    value = "cast(c as int)"
    return (f"aggregate(transform(split(reverse({_digits(x)}), ''), (c, i) -> if(i % 2 = 0, {value}, "
            f"if({value} > 4, 2 * {value} - 9, 2 * {value}))), 0, (a, c) -> a + c) % 10 = 0")


def check(kind: str, x: str) -> str:
    """SQL: does the match ``x`` pass its kind's check?"""
    n = f"length({_digits(x)})"
    return {"email": "true", "ip": f"{x} rlike {sql_str(OCTETS)}",
            "card": f"(length({x}) >= 13 and {n} between 13 and 19 and {luhn(x)})",
            "phone": f"{n} between 9 and 15", "handle": f"{x} rlike '(?i)[\\\\[(]at[\\\\])]'"}.get(kind, "false")


def _gaps(kind: str, pattern: str) -> str:
    """SQL: the matches in p_x_<kind> with their check and the lengths, in code points, of themselves and of
    the text between them (split only where there is a match)."""
    return f"""if(size(p_x_{kind}) > 0, zip_with(p_x_{kind}, slice(split(p_t, {sql_str(pattern)}, -1), 1, size(p_x_{kind})),
        (m, gap) -> named_struct('m', m, 'gap', length(gap), 'len', length(m), 'ok', {check(kind, 'm')})), array())"""


# Running values over a list, in time linear in it but for (n / BLOCK)^2 small steps: a fold over the whole
# list would copy its result at every step. Lists stand in columns that are named twice or more, as the
# optimizer moves a column named once into the lambda that reads it, where it is computed for each element.
BLOCK = 64


def _blocks(c: str) -> str:
    """SQL: the list ``c`` in runs of ``BLOCK``."""
    return f"if(size({c}) > 0, transform(sequence(0, (size({c}) - 1) div {BLOCK}), k -> slice({c}, {BLOCK} * k + 1, {BLOCK})), array())"


def _before_blocks(c: str, value: str, step: str) -> str:
    """SQL: the running value before each run of ``c`` and after the last; ``value`` of a run ``r``, ``step`` from ``{last}`` and ``v``."""
    return f"aggregate(transform({c}, r -> {value}), array(0), (acc, v) -> array_append(acc, {step.format(last='element_at(acc, -1)')}))"


def _placed(kind: str) -> str:
    """SQL: running starts over the runs of (gap, len) structs."""
    return f"""flatten(zip_with(p_k_{kind}, slice(p_o_{kind}, 1, size(p_k_{kind})), (r, at) -> aggregate(r,
        named_struct('at', at, 'out', cast(array() as array<struct<a:int,b:int,m:string,ok:boolean>>)),
        (acc, x) -> named_struct('at', acc.at + x.gap + x.len, 'out', array_append(acc.out,
            named_struct('a', acc.at + x.gap, 'b', acc.at + x.gap + x.len, 'm', x.m, 'ok', x.ok)))).out))"""


# Places in a text are reached through its pieces of this many code points, not from its start.
WINDOW = 128


def _piece(first: str, end: str) -> str:
    """SQL: the code points of p_t from ``first`` to ``end`` (exclusive), read from p_w."""
    return (f"substring(array_join(slice(p_w, ({first}) div {WINDOW} + 1, ({end}) div {WINDOW} - ({first}) div {WINDOW} + 1), ''), "
            f"({first}) % {WINDOW} + 1, ({end}) - ({first}))")


def _near(first: str, end: str) -> str:
    """SQL: like ``_piece``, for at most ``WINDOW`` code points: read from two neighbours, without a slice."""
    return (f"substring(concat(coalesce(get(p_w, ({first}) div {WINDOW}), ''), coalesce(get(p_w, ({first}) div {WINDOW} + 1), '')), "
            f"({first}) % {WINDOW} + 1, ({end}) - ({first}))")


GATES = {"email": "contains(p_t, '@')", "ip": "p_d and contains(p_t, '.')", "card": "p_d", "phone": "p_d and contains(p_t, '+')",
         "number": "p_d", "handle": "p_t rlike '(?i)[\\\\[( ]at[\\\\]) ]'", "secret": "p_d"}


def with_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with p_t (the text), p_w (it in pieces, if it has a candidate), p_base_<kind> (checked spans a, b)
    and p_cand (all candidates)."""
    d = docs.withColumn("p_t", F.coalesce(F.col(text), F.lit(""))).withColumn("p_d", F.expr("p_t rlike '[0-9]'"))
    each = PATTERNS | EXTRA

    def level(make) -> DataFrame:
        return d.withColumns({name: F.expr(sql) for kind, pattern in each.items() for name, sql in [make(kind, pattern)]})

    d = level(lambda k, p: (f"p_x_{k}", f"if({GATES[k]}, regexp_extract_all(p_t, {sql_str(p)}, 0), array())"))
    d = level(lambda k, p: (f"p_m_{k}", _gaps(k, p)))
    d = level(lambda k, p: (f"p_k_{k}", _blocks(f"p_m_{k}")))
    d = level(lambda k, p: (f"p_o_{k}", _before_blocks(f"p_k_{k}", "aggregate(r, 0, (t, x) -> t + x.gap + x.len)", "{last} + v")))
    d = level(lambda k, p: (f"p_s_{k}", _placed(k)))
    some = " + ".join(f"size(p_x_{k})" for k in each)
    d = d.withColumn("p_w", F.expr(f"if({some} > 0, regexp_extract_all(p_t, '(?s).{{1,{WINDOW}}}', 0), array())"))
    d = d.withColumns({f"p_base_{kind}": F.expr(f"filter(p_s_{kind}, x -> x.ok)") for kind in KINDS})
    every = ", ".join(f"transform(p_s_{kind}, x -> named_struct('kind', '{kind}', 'code', {float(code)}D, 'a', x.a, 'b', x.b, 'm', x.m, "
                      f"'before', {_near(f'greatest(0, x.a - {BEFORE})', 'x.a')}, 'after', {_near('x.b', f'x.b + {AFTER}')}, "
                      f"'ok', x.ok))" for code, kind in enumerate(ALL))
    extra = f"x.kind IN ({', '.join(map(sql_str, EXTRA))})"
    d = d.withColumn("p_all", F.expr(f"concat({every})"))
    d = d.withColumn("p_cand", F.expr(f"""transform(p_all, x -> named_struct('kind', x.kind, 'a', x.a, 'b', x.b, 'ok', x.ok,
        'f_len', cast(least(x.b - x.a, 80) as double), 'f_digits', cast(length({_digits('x.m')}) as double) / length(x.m),
        'f_letters', cast(length(regexp_replace(x.m, '[^A-Za-z]', '')) as double) / length(x.m),
        'f_seps', cast(least(length(regexp_replace(x.m, '[A-Za-z0-9]', '')), 20) as double),
        'f_distinct', cast(size(array_distinct(split(substring(x.m, 1, 80), ''))) as double),
        'f_upper', cast(length(regexp_replace(x.m, '[^A-Z]', '')) as double) / length(x.m),
        'e_hint', x.before rlike {sql_str(HINT)}, 'e_assign', x.before rlike {sql_str(ASSIGN)},
        'f_luhn', if(x.kind <> 'card' and {check('card', 'x.m')}, 1D, 0D), 'f_octets', if(x.kind <> 'ip' and {check('ip', 'x.m')}, 1D, 0D),
        'f_assign', if(not {extra} and x.before rlike {sql_str(ASSIGN)}, 1D, 0D),
        'f_line', if(x.a = 0 or x.before rlike '\\\\n$', 1D, 0D), 'f_unit', if(x.after rlike {sql_str(UNIT)}, 1D, 0D), 'f_kind', x.code))"""))
    return d.drop("p_d", "p_all", *[f"p_{c}_{k}" for c in "xmkos" for k in ALL])


def train(candidates: DataFrame) -> tuple[GBTClassificationModel | None, dict[str, float]]:
    """The trees and each kind's threshold, from ``p_cand`` rows."""
    # An inner explode would make the optimizer ask for a non-empty list first, by all candidate work once more at the scan.
    c = candidates.select(F.explode_outer("p_cand").alias("c")).where("c IS NOT NULL").select("c.*")
    # Labels by strong evidence; the other candidates are what the trees are for.
    label = F.expr("""CASE WHEN kind IN ('email', 'ip', 'card', 'phone') THEN if(ok, 1D, if(e_hint, NULL, 0D))
        WHEN ok THEN NULL WHEN e_hint AND e_assign THEN 1D WHEN NOT e_hint AND NOT e_assign THEN 0D END""")
    c = c.withColumn("label", label).where("label IS NOT NULL")
    # All labelled candidates, equal ones as one row with their number; equal features fall on the same side of the split.
    every = written(c.groupBy("kind", "label", *FEATURES).agg(F.count("*").alias("n")), "pii-labelled").withColumn(
        "draw", F.pmod(F.xxhash64("kind", *FEATURES, F.lit(SEED)), F.lit(DRAWS)))
    # Draws below this go to the fit: about as many rows of each kind and label, never more than about half of them.
    strata = {(r["kind"], r["label"]): r["count"] for r in every.groupBy("kind", "label").count().collect()}
    if len({label for _, label in strata}) < 2:
        return None, {}
    upto = {s: min(DRAWS // 2, DRAWS * (SAMPLE // (2 * len(ALL))) // n) for s, n in strata.items()}
    every = every.withColumn("fit", F.expr("draw < CASE " + " ".join(
        f"WHEN kind = '{kind}' AND label = {label!r}D THEN {d}" for (kind, label), d in sorted(upto.items())) + " END"))
    x = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(every.where("fit"))
    # In a fixed order, so that equal input gives equal trees.
    fitted = x.repartition(1).sortWithinPartitions("draw", "kind", "label", *FEATURES)
    if fitted.select("label").distinct().count() < 2:
        return None, {}
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, maxBins=32).fit(fitted)
    scored = every.where("NOT fit").withColumn("score", F.round(F.expr(trees_sql(model, "")), 3))
    # At most 1001 scores for each kind and label: precision of everything at or above each score.
    found = scored.groupBy("kind", "label", "score").agg(F.sum("n").alias("n")).collect()
    cut: dict[str, float] = {}
    for kind in ALL:
        good = total = 0.0
        by: dict[float, list[float]] = {}
        for r in found:
            if r["kind"] == kind:       # each row stands also for the share of its kind and label that the fit took
                by.setdefault(r["score"], [0.0, 0.0])[int(r["label"])] += r["n"] * DRAWS / (DRAWS - upto[kind, r["label"]])
        for score in sorted(by, reverse=True):
            good, total = good + by[score][1], total + sum(by[score])
            if good >= PRECISION * total:
                cut[kind] = float(score)
    return model, cut


def trees_sql(model: GBTClassificationModel, of: str) -> str:
    """SQL: the model's score from 0 to 1 over the fields ``<of>f_...`` of a candidate."""
    def node(n) -> str:
        if n.getClass().getSimpleName() == "LeafNode":
            return f"{n.prediction()!r}D"
        split = n.split()
        return (f"if({of}{FEATURES[split.featureIndex()]} <= {split.threshold()!r}D, {node(n.leftChild())}, {node(n.rightChild())})")

    total = " + ".join(f"{w!r}D * {node(t._call_java('rootNode'))}" for t, w in zip(model.trees, model.treeWeights))
    return f"1D / (1D + exp(-2D * ({total})))"


def _with_spans(d: DataFrame, model: GBTClassificationModel | None, cut: dict[str, float]) -> DataFrame:
    """Adds p_spans: base spans and the method's, as (kind number, a, b, kind), in order."""
    base = ", ".join(f"transform(p_base_{k}, x -> named_struct('o', {i}, 'a', x.a, 'b', x.b, 'kind', '{k}'))" for i, k in enumerate(KINDS))
    scored = "false"
    if model is not None and cut:
        least = "CASE c.kind " + " ".join(f"WHEN '{k}' THEN {v!r}D" for k, v in cut.items()) + " ELSE 2D END"
        scored = f"round({trees_sql(model, 'c.')}, 3) >= {least}"
    order = "CASE c.kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(ALL)) + " END"
    added = (f"transform(filter(p_cand, c -> if(c.ok, c.kind IN ({', '.join(map(sql_str, EXTRA))}), {scored})), "
             f"c -> named_struct('o', {order}, 'a', c.a, 'b', c.b, 'kind', c.kind))")
    return d.withColumn("p_spans", F.expr(f"array_sort(concat({base}, {added}))"))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` for every row."""
    d = with_candidates(docs.select(F.col(key).alias("k"), F.col(text).alias("p_in")), "p_in")
    d = written(d.select("k", *[f"p_base_{k}" for k in KINDS], "p_cand"), "pii-candidates")
    d = _with_spans(d, *train(d.select("p_cand")))
    listed = lambda a: f"array_join(transform({a}, x -> concat(x.kind, ':', x.a, ':', x.b)), ',')"
    base = ", ".join(f"transform(p_base_{k}, x -> named_struct('kind', '{k}', 'a', x.a, 'b', x.b))" for k in KINDS)
    sizes = " + ".join(f"size(p_base_{k})" for k in KINDS)
    return d.select(F.col("k").alias(key), *[F.size(f"p_base_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                    F.sha2(F.expr(listed(f"concat({base})")), 256).alias("base_sha256"), F.expr(listed("p_spans")).alias("spans"),
                    F.expr(f"cast(size(p_spans) - ({sizes}) as bigint)").alias("n_added"))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``<KIND>``; of overlapping spans the union, named
    by its first. ``n_chars``, if there, follows the text. Null texts stay null."""
    cols = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col(text).alias("p_in"))
    d = with_candidates(d, "p_in")
    d = _with_spans(d, *train(d.select("p_cand")))
    # Spans by start. A span that starts before the end of an earlier one belongs to that one's union; the others
    # are heads, with the end of all before them: what lies between is copied.
    d = d.withColumn("p_by", F.expr("array_sort(transform(p_spans, x -> named_struct('a', x.a, 'o', x.o, 'b', x.b, 'kind', x.kind)))"))
    d = d.withColumn("p_bk", F.expr(_blocks("p_by")))
    d = d.withColumn("p_bo", F.expr(_before_blocks("p_bk", "array_max(transform(r, x -> x.b))", "greatest({last}, v)")))
    d = d.withColumn("p_heads", F.expr("""flatten(zip_with(p_bk, slice(p_bo, 1, size(p_bk)), (r, at) -> aggregate(r,
        named_struct('at', at, 'out', cast(array() as array<struct<at:int,a:int,kind:string>>)),
        (acc, x) -> named_struct('at', greatest(acc.at, x.b), 'out', if(x.a < acc.at, acc.out,
            array_append(acc.out, named_struct('at', acc.at, 'a', x.a, 'kind', x.kind))))).out))"""))
    d = d.withColumn("p_new", F.expr(f"""concat(array_join(transform(p_heads, x -> concat({_piece('x.at', 'x.a')}, '<', upper(x.kind), '>')), ''),
        {_piece('element_at(p_bo, -1)', 'length(p_t)')})"""))
    new = F.when(F.col("p_in").isNotNull(), F.when(F.size("p_spans") > 0, F.col("p_new")).otherwise(F.col("p_in")))
    out = {text: new.alias(text)}
    if "n_chars" in cols and text in cols:
        out["n_chars"] = F.when(F.size("p_spans") > 0, F.length("p_new").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("row.n_chars")).alias("n_chars")
    return d.select(*[out.get(c, F.col(f"row.`{c}`")) for c in cols])
