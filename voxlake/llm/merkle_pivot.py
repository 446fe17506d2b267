"""Merkle manifest of a table, by slot pivots.

A row is a leaf: the hash of its fields, each ``-`` if null, else its length in UTF-8 bytes, a colon and its
value. Leaves of one part (``lang``) ascend by key; every ``FANOUT`` consecutive nodes become the hash of
their digests, until one is left: the part's subroot. Subroots in order of the parts give the root the same
way. A node that is alone in its part stays as it is.

Positions come without a global window: rows are range-partitioned and sorted by part, key and leaf, numbered
inside their task, and shifted by the counts of the tasks before them (one small row for each task and part),
so a part that holds most rows is spread over all tasks. A level is one pivot: a group by the parent's
position in which one conditional aggregate for each slot puts the child of that slot into its column. The
columns joined give the parent; the columns without the own slot give a child's siblings. Each level is
written once (an eighth of the level below). Proofs go down the written levels: a row has the path of its
parent, and its children get it with the siblings of their slot in front; rows of documents are met by the
pivot of the lowest level, which carries their keys and claimed leaves, so no join meets them.

Defined cases: nulls in any field hash as ``-``; a null part is a part of its own, before all others; a null
key comes before all keys; rows with equal part and key are ordered by their leaf, and equal rows are equal
leaves at neighbouring places; a table of one row has that leaf as subroot and root and the hash of nothing
as proof; an empty table has no leaf and an empty result; columns that are no fields are ignored, also
such that are named like the result's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxlake.llm.common import written

FANOUT = 8
#: Fixed values of the contract: the fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(columns: list[Column]) -> Column:
    """Hash of the fields, each with its length."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def positioned(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0, within the part ``g``) and ``total`` (the part's rows)."""
    cols = rows.columns
    sorted_ = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    numbered = written(sorted_.withColumn("at", F.monotonically_increasing_id()), name).withColumn("task", F.shiftright("at", 33))
    w = Window.partitionBy("g")
    runs = numbered.groupBy("g", "task").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # One row for each task and part; written, so that its size is known when it is joined.
    runs = written(runs.select("g", "task", "first", (F.sum("n").over(w.orderBy("task")) - F.col("n")).alias("before"),
                               F.sum("n").over(w).alias("total")), name + "-runs")
    return numbered.join(runs, ["g", "task"]).select(*cols, (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "total")


def pivot(nodes: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Parents of ``nodes`` (g, pos, total, h): ``g, pos, total, c0..`` and ``h``; ``carry`` columns of a child
    become ``<name>0..``. A single node is its own parent."""
    slot = F.col("pos") % FANOUT
    spread = [F.max(F.when(slot == s, F.col(name))).alias(f"{to}{s}") for name, to in [("h", "c"), *((c, c) for c in carry)] for s in range(FANOUT)]
    up = nodes.groupBy("g", F.floor(F.col("pos") / FANOUT).cast("long").alias("up"), "total").agg(*spread)
    joined = F.concat_ws("", *[f"c{s}" for s in range(FANOUT)])
    return up.select("g", F.col("up").alias("pos"), F.col("total").alias("below"), F.ceil(F.col("total") / FANOUT).cast("long").alias("total"),
                     *[c for c in up.columns if c not in ("g", "up", "total")],
                     F.when(F.col("total") == 1, F.col("c0")).otherwise(F.sha2(joined, 256)).alias("h"))


def levels(nodes: DataFrame, most: int, name: str, carry: list[str] = ()) -> list[DataFrame]:
    """The written levels above ``nodes``, the lowest first; ``most`` is the size of the largest part."""
    out = [written(pivot(nodes, carry), f"{name}-1")]
    while (most := -(-most // FANOUT)) > 1:
        out.append(written(pivot(out[-1].select("g", "pos", "total", "h")), f"{name}-{len(out) + 1}"))
    return out


def _children(level: DataFrame, carry: list[str] = (), keep: list[str] = ()) -> DataFrame:
    """Each child of the pivoted rows: ``g, pos, h, path`` and the columns ``carry``, ``keep``. ``path`` holds the
    siblings left and right of it, from its own level to the root."""
    def side(slots) -> Column:
        return F.concat_ws("", *[F.col(f"c{s}") for s in slots]) if slots else F.lit("")

    child = [F.when(F.col(f"c{s}").isNotNull(), F.struct(
        (F.col("pos") * FANOUT + s).alias("pos"), F.col(f"c{s}").alias("h"), *[F.col(f"{c}{s}").alias(c) for c in carry],
        F.struct(side(range(s)).alias("l"), side(range(s + 1, FANOUT)).alias("r")).alias("own"))) for s in range(FANOUT)]
    each = level.select("g", "below", "path", *keep, F.explode(F.array_compact(F.array(*child))).alias("x"))
    path = F.when(F.col("below") == 1, F.col("path")).otherwise(F.concat(F.array(F.col("x.own")), F.col("path")))
    return each.select("g", "x.pos", "x.h", path.alias("path"), *[F.col(f"x.{c}").alias(c) for c in carry], *keep)


def _paths(tree: list[DataFrame], top: DataFrame, carry: list[str], keep: list[str]) -> DataFrame:
    """Paths of the nodes below ``tree`` from those of its tops (g, path, keep): down level by level."""
    now = tree[-1].join(top, "g")
    for i in range(len(tree) - 1, 0, -1):
        now = tree[i - 1].join(_children(now, keep=keep).select("g", "pos", "path", *keep), ["g", "pos"])
    return _children(now, carry, keep)


@dataclass
class Manifest:
    """The written levels of the parts' trees and of the tree over their subroots."""

    parts: list[DataFrame]
    over: list[DataFrame]

    def subroots(self) -> DataFrame:
        """``g`` (a part, ``0`` for null, else ``1`` and its name) and its ``subroot``."""
        return self.parts[-1].select("g", F.col("h").alias("subroot"))

    def root(self) -> str | None:
        """The root of the whole table; None if it is empty."""
        row = self.over[-1].select("h").first()
        return None if row is None else row["h"]

    def proofs(self) -> DataFrame:
        """For each row ``id, leaf, claim, subroot, root`` and ``path``, the (left, right) siblings up to the root."""
        no_path = F.lit([]).cast("array<struct<l:string,r:string>>")
        top = self.over[-1].select("g", F.col("h").alias("root"), no_path.alias("path"))
        tops = _paths(self.over, top, ["part"], ["root"]).select(F.col("part").alias("g"), F.col("h").alias("subroot"), "path", "root")
        return _paths(self.parts, tops, ["id", "claim"], ["subroot", "root"]).select(
            "id", F.col("h").alias("leaf"), "claim", "subroot", "root", "path")


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", part: str = "lang",
          received: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``. ``received`` replaces fields, by name, for the leaf that each row claims later;
    it is computed in the same scan."""
    own = {f: F.col(f"`{f}`") for f in fields}
    rows = docs.select(F.coalesce(F.concat(F.lit("1"), F.col(part).cast("string")), F.lit("0")).alias("g"), F.col(key).alias("id"),
                       leaf(list(own.values())).alias("h"), leaf(list((own | (received or {})).values())).alias("claim"))
    # The narrow rows are written before the range partitioning samples them: the texts are read once.
    leaves = positioned(written(rows, "merkle-leaves"), ["id", "h"], "merkle-order")
    most = leaves.agg(F.max("total")).first()[0] or 0
    parts = levels(leaves, most, "merkle-parts", ["id", "claim"])
    tops = parts[-1].select(F.lit("").alias("g"), F.col("g").alias("part"), "h")
    tops = positioned(tops, ["part"], "merkle-tops")
    return Manifest(parts, levels(tops, tops.agg(F.max("total")).first()[0] or 0, "merkle-over", ["part"]))


def proof_digest(path: str = "path") -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["l"], p["r"])), ""), 256)


def folded(leaf_: str = "claim", path: str = "path") -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, F.col(leaf_), lambda h, p: F.sha2(F.concat(p["l"], h, p["r"]), 256))
