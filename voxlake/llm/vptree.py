"""Nearest neighbours by vantage-point trees per shard.

Vectors are dealt to shards of about ``SHARD_ROWS`` by a hash of their id. Each shard builds a tree: a
node keeps one vector as its vantage point, splits the rest at the median distance to it, and remembers
the range of distances of either side. A search carries the distance ``tau`` of the k-th nearest so far
and skips a side if ``factor * gap > tau``, where ``gap`` is how far the query's distance to the vantage
point lies outside the side's range: by the triangle inequality nothing nearer than ``gap`` is there, so
factor 1 is exact, and larger factors skip more. Queries travel through a tree in batches, the nearer
side first.

Queries meet every shard in blocks of ``QUERY_BLOCK``: the work unit is one (shard, block) pair, so a
task holds one shard and one block, whatever the table's size; each unit returns at most k rows a query,
and the k best over the shards follow from a window over those.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part,
nor do null ids; only vectors of the query's length are compared; rows that repeat an id count once (the
smallest vector); equal vectors under different ids are all kept, ties go to the smaller id; an empty
table gives an empty table; fewer candidates than k give all of them; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlake.llm.common import python_ready, written

SHARD_ROWS = 4096
QUERY_BLOCK = 2048
LEAF = 48
FACTOR = 1.2
CELLS = 1 << 21         # differences at once
SEED = 7


def distances(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, as they are defined (no expansion of the square)."""
    out = np.empty((len(q), len(v)))
    step = max(1, CELLS // max(1, v.size))
    for a in range(0, len(q), step):
        d = q[a : a + step, None, :] - v[None]
        out[a : a + step] = np.sqrt(np.einsum("ijk,ijk->ij", d, d))
    return out


class Tree:
    """A vantage-point tree over the rows of ``vectors``."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.ids, self.vectors, self.leaf = ids, vectors, leaf
        self.random = np.random.default_rng(SEED)
        self.root = self._build(np.arange(len(ids)))

    def _build(self, at: np.ndarray):
        if len(at) <= self.leaf:
            return at
        # The vantage point: of a few rows, the one whose distances to a few others vary most.
        some = self.random.choice(at, min(8, len(at)), replace=False)
        others = self.random.choice(at, min(64, len(at)), replace=False)
        point = some[distances(self.vectors[some], self.vectors[others]).var(axis=1).argmax()]
        rest = at[at != point]
        d = distances(self.vectors[point][None], self.vectors[rest])[0]
        middle = np.median(d)
        near = d <= middle
        if near.all():                      # the rest is no farther: all at one distance, or half of them
            near = d < middle
        if not near.any() or near.all():
            return at                       # equal distances: no split tells them apart
        sides = [(self._build(rest[m]), d[m].min(), d[m].max()) for m in (near, ~near)]
        return point, sides

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest other rows of each query (missing ones: infinite)."""
        best = np.full((len(queries), k), np.inf)
        names = np.full((len(queries), k), np.iinfo(np.int64).max)

        def offer(at: np.ndarray, rows: np.ndarray, d: np.ndarray) -> None:
            d = np.where(self.ids[rows][None] == query_ids[at][:, None], np.inf, d)
            here = d.min(axis=1) <= best[at, -1]
            at, d = at[here], d[here]
            if not len(at):
                return
            both = np.concatenate([best[at], d], axis=1)
            ids = np.concatenate([names[at], np.broadcast_to(self.ids[rows], d.shape)], axis=1)
            ids[np.isinf(both)] = np.iinfo(np.int64).max
            order = np.lexsort((ids, both), axis=-1)[:, :k]
            best[at], names[at] = np.take_along_axis(both, order, 1), np.take_along_axis(ids, order, 1)

        def visit(node, at: np.ndarray) -> None:
            if not len(at):
                return
            if isinstance(node, np.ndarray):
                for a in range(0, len(node), 1024):
                    rows = node[a : a + 1024]
                    offer(at, rows, distances(queries[at], self.vectors[rows]))
                return
            point, sides = node
            d = distances(queries[at], self.vectors[point][None])
            offer(at, np.array([point]), d)
            d = d[:, 0]
            gaps = [np.maximum(np.maximum(lo - d, d - hi), 0) for _, lo, hi in sides]
            first = gaps[0] <= gaps[1]
            for side, mine in ((0, first), (1, ~first), (1, first), (0, ~first)):
                open_ = mine & (factor * gaps[side] <= best[at, -1])
                visit(sides[side][0], at[open_])

        if len(self.ids):
            visit(self.root, np.arange(len(queries)))
        return names, best


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v`` of the vectors that take part, one per id."""
    d = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.expr("""id IS NOT NULL AND size(v) > 0
        AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists(v, x -> x <> 0)""")
    return d.where(fine).groupBy("id").agg(F.min("v").alias("v"))


def nearest(table: DataFrame, every: int = 100, k: int = 10, factor: float = FACTOR, shard_rows: int = SHARD_ROWS,
            query_block: int = QUERY_BLOCK, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the queries ``key % every = 0`` against all rows."""
    python_ready(table.sparkSession)
    v = written(usable(table, key, vector), "vector-rows")
    sizes = v.agg(F.count("*"), F.count(F.when(F.col("id") % every == 0, 1))).first()
    shards, blocks = max(1, -(-sizes[0] // shard_rows)), max(1, -(-sizes[1] // query_block))
    deal = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    rows = v.select(deal(shards, 1).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                    F.size("v").alias("width"), "id", "v")
    asked = v.where(F.col("id") % every == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), deal(blocks, 2).alias("block"),
        F.size("v").alias("width"), "id", "v")

    def search(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        data, queries = data.sort_values("id"), queries.sort_values("id")
        tree = Tree(data["id"].to_numpy(), np.stack(data["v"].to_list()).astype(float))
        asked_ids = queries["id"].to_numpy()
        names, best = tree.search(asked_ids, np.stack(queries["v"].to_list()).astype(float), k, factor)
        found = np.isfinite(best)
        return pd.DataFrame({"query_id": np.repeat(asked_ids, found.sum(axis=1)), "vec_id": names[found], "score": best[found]})

    unit = ["shard", "block", "width"]
    found = rows.groupBy(*unit).cogroup(asked.groupBy(*unit)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
