r"""Quality rules with robust multivariate outliers: minimum covariance determinant (native).

Base statistics of each whole text (words are ``[^\x20\x09-\x0D]+``): ``n_words``, ``word_chars``,
``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (words inside a 3-word window found twice or more).
A text fails the base rule with fewer than 50 words or more than half of them repeated.

The method: four transformed statistics (log mean word length, and square roots of the symbol,
duplicate-line and repeated-word shares) form a vector; per language and source the mean and
covariance of the most concentrated ``SUPPORT`` of the vectors are estimated by concentration steps
from two deterministic starts (median and MAD; mean and variance), keeping the start with the
smaller determinant. A text that passes the base rule is rejected if its squared Mahalanobis
distance exceeds ``CUTOFF``. Covariances carry the floor ``FLOORS`` on their diagonal, so that groups
where most texts share one value (no symbols at all) stay regular.

Groups with fewer than ``MIN_GROUP`` fitting texts use their language's estimate, and languages with
fewer use the whole table's; with fewer than ``MIN_GROUP`` texts in the whole table nothing is rejected.

Scale: statistics are computed inside each row (no explode, no shuffle of texts) and written once as
a narrow table; every step is a partial aggregate over it (quantile sketches and moments), so a group
with a third of the rows costs one small state per task. Group tables are written and reread, so
Spark knows their size and broadcasts them only below its threshold, else the join shuffles the narrow
table and AQE splits a hot group.

Defined cases: null or blank texts have zero statistics and fail the base rule; null language or
source form groups of their own; repeated rows are judged alike; an empty table gives an empty
table; other columns of the input are ignored (``rules``) or kept (``passing``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import WORD_SPLIT, WORD_STRIP, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SUPPORT = 0.75          # share of a group's vectors that the determinant is minimised over
STEPS = 3               # concentration steps
MIN_GROUP = 60
CUTOFF = 33.4           # chi-square, 4 degrees of freedom, upper tail 1e-6
CHI_MEDIAN = 3.357      # its median, for the consistency factor
FLOORS = [0.06, 0.05, 0.15, 0.12]
ACCURACY = 2000         # of the quantile sketches
P = len(FLOORS)
MAX_BROADCAST = 100_000 # groups, about 200 bytes each
SYMBOLS = r"[#*$%&|<>]"

DIMS = range(P)
PAIRS = [(i, j) for i in DIMS for j in range(i + 1)]
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns ``q_<statistic>`` and ``q_lines`` (intermediate ``q_`` columns dropped)."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumn("q_t", t)
    d = d.withColumn("q_s", F.expr("btrim(q_t, ' \\t\\n\\u000b\\u000c\\r')"))
    d = d.withColumn("q_w", F.when(F.length("q_s") == 0, F.array().cast("array<string>")).otherwise(F.split("q_s", WORD_SPLIT, -1)))
    d = d.withColumn("q_n_words", F.size("q_w").cast("long"))
    d = d.withColumn("q_word_chars", F.length(F.array_join("q_w", "")).cast("long"))
    d = d.withColumn("q_n_symbols", F.regexp_count("q_t", F.lit(SYMBOLS)).cast("long"))
    # Only the wrapped column is used below: one pass over the lines that hold a word.
    d = d.withColumn("q_l", F.expr("filter(split(q_t, '\\n', -1), x -> length(btrim(x, ' \\t\\n\\u000b\\u000c\\r')) > 0)"))
    d = d.withColumn("q_lines", F.size("q_l").cast("long"))
    d = d.withColumn("q_n_dup_lines", (F.size("q_l") - F.size(F.array_distinct("q_l"))).cast("long"))
    # Hashes of the 3-word windows, in text order; most texts have no window twice and stop here.
    d = d.withColumn("q_h", F.expr(
        "slice(transform(q_w, (w, i) -> xxhash64(w, get(q_w, i + 1), get(q_w, i + 2))), 1, greatest(size(q_w) - 2, 0))"))
    d = d.withColumn("q_z", F.when(F.size(F.array_distinct("q_h")) < F.size("q_h"), F.expr(
        "array_sort(transform(q_h, (x, i) -> named_struct('h', x, 'i', i)))")))
    d = d.withColumn("q_p", F.expr(
        "sort_array(transform(filter(q_z, (s, j) -> s.h = get(q_z, j - 1).h or s.h = get(q_z, j + 1).h), s -> s.i))"))
    d = d.withColumn("q_n_repeat_words", F.expr(
        "if(q_p is null, 0L, aggregate(transform(q_p, (x, j) -> if(j = 0, 3, least(3, x - q_p[j - 1]))), 0L, (a, x) -> a + x))"))
    return d.drop("q_t", "q_s", "q_w", "q_l", "q_h", "q_z", "q_p")


def base_failed() -> Column:
    return (F.col("q_n_words") < MIN_WORDS) | (100 * F.col("q_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("q_n_words"))


def vector() -> list[Column]:
    """The transformed statistics x0..x3."""
    n, c = F.greatest(F.col("q_n_words"), F.lit(1)), F.greatest(F.col("q_word_chars"), F.lit(1))
    return [F.log(c / n), F.sqrt(F.col("q_n_symbols") / c),
            F.sqrt(F.col("q_n_dup_lines") / F.greatest(F.col("q_lines"), F.lit(1))), F.sqrt(F.col("q_n_repeat_words") / n)]


def group_keys(lang: Column, source: Column) -> list[Column]:
    """Group names, finest first; nulls have a name of their own, and a length keeps pairs apart."""
    mark = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("~"))
    a, b = mark(lang), mark(source)
    return [F.concat(F.lit("s"), F.length(a), F.lit(":"), a, b), F.concat(F.lit("l"), a), F.lit("a")]


def _distance(mean: str, chol: str) -> Column:
    """Squared Mahalanobis distance of x0.. by forward substitution on the Cholesky factor."""
    ys: list[Column] = []
    for i in DIMS:
        y = F.col(f"x{i}") - F.col(f"{mean}{i}")
        for j in range(i):
            y = y - F.col(f"{chol}{i}{j}") * ys[j]
        ys.append(y / F.col(f"{chol}{i}{i}"))
    total = ys[0] * ys[0]
    for y in ys[1:]:
        total = total + y * y
    return total


def _with_cholesky(params: DataFrame) -> DataFrame:
    """Adds the Cholesky factor l<i><j> of c<i><j> plus the diagonal floor, and log-determinant ld."""
    for i in DIMS:
        for j in range(i + 1):
            v = F.col(f"c{i}{j}") + (F.lit(FLOORS[i] ** 2) if i == j else F.lit(0.0))
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            v = F.sqrt(F.greatest(v, F.lit(1e-12))) if i == j else v / F.col(f"l{j}{j}")
            params = params.withColumn(f"l{i}{j}", v)
    ld = F.log(F.col("l00"))
    for i in range(1, P):
        ld = ld + F.log(F.col(f"l{i}{i}"))
    return params.withColumn("ld", ld)


def _moments() -> list[Column]:
    out = [F.avg(f"x{i}").alias(f"m{i}") for i in DIMS]
    return out + [F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i, j in PAIRS]


def fit(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Estimates of ``(lang, source, x0..)`` rows that pass the base rule.

    Returns ``(of, params)``: ``of`` maps each fine group to the group whose estimate it uses, and
    ``params`` holds mean ``m``, Cholesky factor ``l`` and the consistency factor ``f`` by group ``g``.
    """
    fine, lang, whole = group_keys(F.col("lang"), F.col("source"))
    v = vectors.select(fine.alias("g0"), lang.alias("g1"), whole.alias("g2"), *[f"x{i}" for i in DIMS])
    counts = written(v.groupBy("g0", "g1", "g2").count(), "mcd-counts")
    by_lang = counts.groupBy("g1").agg(F.sum("count").alias("n1"))
    total = counts.groupBy("g2").agg(F.sum("count").alias("n2"))
    of = counts.join(by_lang, "g1").join(total, "g2").select(
        "g0", F.when(F.col("count") >= MIN_GROUP, F.col("g0")).when(F.col("n1") >= MIN_GROUP, F.col("g1"))
        .when(F.col("n2") >= MIN_GROUP, F.col("g2")).alias("g"))
    of = written(of, "mcd-groups")
    used = written(of.where(F.col("g").isNotNull()).select("g").distinct(), "mcd-used")
    # A row fits every used group that it lies in (a coarse one only where some small group needs it).
    x = v.select(F.explode(F.array("g0", "g1", "g2")).alias("g"), *[f"x{i}" for i in DIMS])
    x = written(x.join(used, "g"), "mcd-vectors")

    # Start 0: medians and MADs. Start 1: means and variances. Both as diagonal covariances.
    med = written(x.groupBy("g").agg(*[F.percentile_approx(f"x{i}", 0.5, ACCURACY).alias(f"m{i}") for i in DIMS],
                                     *[F.avg(f"x{i}").alias(f"a{i}") for i in DIMS],
                                     *[F.var_pop(f"x{i}").alias(f"v{i}") for i in DIMS]), "mcd-start")
    mad = x.join(med, "g").groupBy("g").agg(*[
        F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, ACCURACY).alias(f"d{i}") for i in DIMS])
    start = med.join(mad, "g")
    diag = lambda d: [(d(i) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS]
    first = start.select("g", F.lit(0).alias("s"), *[f"m{i}" for i in DIMS], *diag(lambda i: F.pow(1.4826 * F.col(f"d{i}"), 2)))
    second = start.select("g", F.lit(1).alias("s"), *[F.col(f"a{i}").alias(f"m{i}") for i in DIMS], *diag(lambda i: F.col(f"v{i}")))
    params = written(_with_cholesky(first.unionByName(second)), "mcd-params")
    for _ in range(STEPS):
        d2 = x.join(params, "g").select("g", "s", *[f"x{i}" for i in DIMS], _distance("m", "l").alias("d2"))
        cut = written(d2.groupBy("g", "s").agg(F.percentile_approx("d2", SUPPORT, ACCURACY).alias("cut")), "mcd-cut")
        within = x.join(params.join(cut, ["g", "s"]), "g").where(_distance("m", "l") <= F.col("cut"))
        params = written(_with_cholesky(within.groupBy("g", "s").agg(*_moments())), "mcd-params")
    best = params.groupBy("g").agg(F.min(F.struct("ld", "s", *[f"m{i}" for i in DIMS], *[f"l{i}{j}" for i, j in PAIRS])).alias("b"))
    best = best.select("g", "b.*")
    # Consistency: the median distance of a normal sample is the chi-square median; never shrink.
    factor = x.join(best, "g").groupBy("g").agg(F.percentile_approx(_distance("m", "l"), 0.5, ACCURACY).alias("md"))
    best = best.join(factor, "g").withColumn("f", F.greatest(F.lit(1.0), F.col("md") / CHI_MEDIAN)).drop("md", "ld", "s")
    return of, written(best, "mcd-fit")


def _judged(d: DataFrame, of: DataFrame, params: DataFrame) -> DataFrame:
    """Adds ``q_distance`` (null without an estimate) and ``q_kept`` to rows with q_base, q_g0 and x0..."""
    p = written(of.join(params, "g", "left").withColumnRenamed("g0", "q_g0").withColumnRenamed("g", "q_g"), "mcd-by-group")
    # The rows carry texts, so they should not move: broadcast up to a counted size, beyond it shuffle.
    d = d.join(F.broadcast(p) if p.count() <= MAX_BROADCAST else p, "q_g0", "left")
    d = d.withColumn("q_distance", _distance("m", "l") / F.col("f"))
    return d.withColumn("q_kept", ~F.col("q_base") & (F.coalesce(F.col("q_distance"), F.lit(0.0)) <= CUTOFF))


def _prepared(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    d = with_statistics(docs, text).withColumn("q_base", base_failed())
    d = d.withColumns({f"x{i}": c for i, c in enumerate(vector())})
    return d.withColumn("q_g0", group_keys(F.col(lang), F.col(source))[0])


def rules(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: key, statistics, ``base_failed``, ``distance``, ``kept``."""
    narrow = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    d = written(_prepared(narrow, "lang", "source", "t").drop("t"), "quality-stats")
    out = _judged(d, *fit(d.where(~F.col("q_base"))))
    return out.select(F.col("k").alias(key), *[F.col(f"q_{s}").alias(s) for s in STATS],
                      F.col("q_base").alias("base_failed"), F.col("q_distance").alias("distance"), F.col("q_kept").alias("kept"))


def passing(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they are.

    Statistics are computed twice (once for the fit, once beside the row): cheaper than moving texts.
    """
    cols = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col(text).alias("t"),
                         F.col(lang).alias("lang"), F.col(source).alias("source"))
    d = _prepared(packed, "lang", "source", "t")
    x = written(d.select("q_base", "lang", "source", *[f"x{i}" for i in DIMS]), "quality-stats").where(~F.col("q_base"))
    # The mark keeps the optimizer from moving the filter below the statistics, which would expand them
    # once for each use (it moves no filter below a non-deterministic column).
    d = d.withColumn("q_mark", F.monotonically_increasing_id())
    return _judged(d, *fit(x)).where("q_kept AND q_mark >= 0").select("row.*")
