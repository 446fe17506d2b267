"""URL filter: hash-prefix join of host-suffix x path-prefix expressions (native).

Each URL is split into host and path, expanded into every (host suffix, path prefix) expression
a rule could name, and joined to the rules on the first 8 hex digits of the expression's SHA-256;
the full digest then confirms a hit, and the most specific rule wins.

Rules are a DataFrame ``(host, path, verdict, tier)``: a rule fits its host and every subdomain
if the URL's path starts with ``path``. Precedence: tier (0 before 1: the caller's rules before
the operator's own), then the longest ``host + path``, then block before allow.

Skew and memory: expansion happens inside each row, and the join aggregates nothing: the rules
are the small side, and Spark broadcasts them only if their measured size allows, else AQE splits
skewed hash prefixes of the shuffle join. All expressions of a row meet again in one partial aggregate.

Defined cases: a null URL, or one without ``://``, has empty host and path, no rule and the
default verdict; repeated rows give repeated rows; an empty table gives an empty table; further
columns of the input are ignored; path prefixes are cut at every ``/`` and at the length of every
rule path that does not end in one, so "starts with" is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import lower_az

# The rules of the contract (host, path, verdict).
BASE_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
              ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
# The operator's own rules, used where no given rule fits: host labels of gambling, adult, pharmacy,
# advertising and spam sites in the reserved example domains.
OWN_LABELS = ["adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
OWN_RULES = [(f"{label}.example.{tld}", "/", "block") for label in OWN_LABELS for tld in ("com", "net", "org")]
PREFIX_HEX = 8


def rules_frame(spark: SparkSession, given=tuple(BASE_RULES), own=tuple(OWN_RULES)) -> DataFrame:
    rows = [(h, p, v, 0) for h, p, v in given] + [(h, p, v, 1) for h, p, v in own]
    values = ", ".join(f"('{h}', '{p}', '{v}', {t})" for h, p, v, t in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict, tier)")


def host_of(url: Column) -> Column:
    return lower_az(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
          default: str = "allow") -> DataFrame:
    """``key, host, path, rule, verdict, own_rule`` for every row of ``pages``.

    ``rule`` is the winning given rule (tier 0) as ``host + path``; ``own_rule`` names the
    operator's own rule that decided where no given one fits.
    """
    # One small row: how deep hosts go and which path lengths end within a segment.
    shape = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"),
                      F.max(F.size(F.split("path", "/"))).alias("segments"),
                      F.collect_set(F.when(~F.col("path").endswith("/"), F.length("path"))).alias("cuts")).first()
    labels, segments = shape["labels"] or 0, shape["segments"] or 0
    cuts = sorted(shape["cuts"] or [])
    u = pages.select(F.col(key).alias("k"), host_of(F.col(url)).alias("h"), path_of(F.col(url)).alias("p"))
    u = u.withColumn("row", F.monotonically_increasing_id())    # keeps repeated rows apart
    hosts = f"""transform(sequence(1, least({labels}, size(split(h, '\\\\.')))),
                 n -> substring_index(h, '.', -n))"""
    # Prefixes that end in '/': one for each slash up to the deepest rule, and cuts inside segments.
    slashes = f"""transform(filter(sequence(1, greatest(1, least({max(segments, 1)}, size(split(p, '/')) - 1))),
                 n -> contains(p, '/')), n -> concat(substring_index(p, '/', n), '/'))"""
    inside = f"filter(array({', '.join(f'substring(p, 1, {n})' for n in cuts)}), x -> true)" if cuts else "array()"
    u = u.withColumn("hs", F.expr(hosts)).withColumn(
        "ps", F.expr(f"array_distinct(concat({slashes}, cast({inside} as array<string>)))"))
    x = u.select("row", "k", "h", "p", F.explode("hs").alias("eh"), "ps")
    x = x.select("row", "k", "h", "p", "eh", F.explode_outer("ps").alias("ep"))
    x = x.withColumn("digest", F.sha2(F.concat("eh", "ep"), 256)).withColumn(
        "short", F.substring("digest", 1, PREFIX_HEX))
    r = rules.select(F.concat("host", "path").alias("name"), "verdict", "tier",
                     F.sha2(F.concat("host", "path"), 256).alias("full"))
    r = r.withColumn("short", F.substring("full", 1, PREFIX_HEX))
    hit = x.join(r, "short", "left")
    won = F.struct((-F.col("tier")).alias("t"), F.length("name").alias("len"), F.col("verdict").alias("v"),
                   F.col("name").alias("name"))
    # Lowest tier, then longest, then block ("block" > "allow"); max over a struct is a partial aggregate.
    out = hit.groupBy("row", "k", "h", "p").agg(
        F.max(F.when(F.col("digest") == F.col("full"), won)).alias("b"))
    given = F.col("b.t") == 0
    return out.select(F.col("k").alias(key), F.col("h").alias("host"), F.col("p").alias("path"),
                      F.when(given, F.col("b.name")).alias("rule"),
                      F.coalesce(F.col("b.v"), F.lit(default)).alias("verdict"),
                      F.when(~given, F.col("b.name")).alias("own_rule"))
