"""Header bounds, the G x G chunk grid and point -> chunk assignment (S1.1, S1.2, S2.1, S2.2, S2.11).

The reference issues one box query per chunk. Here a chunk is a column computed from the
point itself, so assigning every point costs one arithmetic projection, and each point
lands in exactly one chunk: cells are half-open, the last row and column closed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.functions import dlit


VALID_SQL = ("coalesce(x > CAST('-Infinity' AS DOUBLE) AND x < CAST('Infinity' AS DOUBLE) AND "
             "y > CAST('-Infinity' AS DOUBLE) AND y < CAST('Infinity' AS DOUBLE) AND "
             "z > CAST('-Infinity' AS DOUBLE) AND z < CAST('Infinity' AS DOUBLE), false)")


def points_bounds(points: DataFrame) -> DataFrame:
    """Dataset header in one pass (S1.1, S4.3): extents of the valid points and the row count."""
    aggs = [f"{fn}(CASE WHEN {VALID_SQL} THEN {c} END) AS {fn}_{c}"
            for c in ("x", "y", "z") for fn in ("min", "max")]
    return points.selectExpr(*aggs, "count(1) AS point_count").select(
        "min_x", "max_x", "min_y", "max_y", "min_z", "max_z", "point_count")


@dataclass(frozen=True)
class Bounds:
    min_x: float
    max_x: float
    min_y: float
    max_y: float
    min_z: float = 0.0
    max_z: float = 0.0
    point_count: int = 0

    @staticmethod
    def of(points: DataFrame) -> "Bounds":
        """Run the one-row header aggregate; the driver receives exactly one row."""
        row = points_bounds(points).first()
        vals = {k: (0.0 if row[k] is None else float(row[k]))
                for k in ("min_x", "max_x", "min_y", "max_y", "min_z", "max_z")}
        return Bounds(point_count=int(row["point_count"]), **vals)


# Tables with a row per chunk are broadcast, so the grid is bounded: 10^6 chunks of ~40 bytes are ~40 MB.
MAX_GRID = 1000


@dataclass(frozen=True)
class Grid:
    """G x G split of the XY extent; chunk ``i_j`` has ``i`` along x (outer) and ``j`` along y."""

    bounds: Bounds
    size: int

    def __post_init__(self):
        if not 1 <= int(self.size) <= MAX_GRID:
            raise ValueError(f"grid size must be in 1..{MAX_GRID} (chunk tables are broadcast), got {self.size}")

    @property
    def x_step(self) -> float:
        return (self.bounds.max_x - self.bounds.min_x) / self.size

    @property
    def y_step(self) -> float:
        return (self.bounds.max_y - self.bounds.min_y) / self.size

    @property
    def n_chunks(self) -> int:
        return self.size * self.size

    def _cell_sql(self, c: str, lo: float, step: float) -> str:
        # Zero extent gives step 0; ANSI mode would raise on the division, so use cell 0.
        if step <= 0:
            return "0"
        return f"CAST(least(floor(({c} - {dlit(lo)}) / {dlit(step)}), {self.size - 1}) AS INT)"

    def in_extent_sql(self) -> str:
        b = self.bounds
        return (f"x BETWEEN {dlit(b.min_x)} AND {dlit(b.max_x)} AND "
                f"y BETWEEN {dlit(b.min_y)} AND {dlit(b.max_y)}")

    def chunk_sql(self) -> str:
        b = self.bounds
        i = self._cell_sql("x", b.min_x, self.x_step)
        j = self._cell_sql("y", b.min_y, self.y_step)
        return f"CASE WHEN {self.in_extent_sql()} THEN {i} * {self.size} + {j} END"

    def assign(self, points: DataFrame) -> DataFrame:
        """Add the chunk ordinal ``chunk = i * G + j`` (S2.2). Points outside the extent get NULL.

        An int ordinal (not the id string) travels through the shuffles; the ``i_j`` id is
        derived after aggregation.
        """
        return points.withColumn("chunk", F.expr(self.chunk_sql()))

    def chunk_id(self, chunk: str = "chunk") -> Column:
        g = self.size
        return F.expr(f"concat_ws('_', CAST({chunk} DIV {g} AS STRING), CAST({chunk} % {g} AS STRING))")

    def chunks(self, spark: SparkSession) -> DataFrame:
        """The grid as a DataFrame of G^2 rows (S2.1); boxes are ``min + k * step``."""
        b, g = self.bounds, self.size
        sx, sy = dlit(self.x_step), dlit(self.y_step)
        return spark.range(g * g).selectExpr(
            f"concat_ws('_', CAST(id DIV {g} AS STRING), CAST(id % {g} AS STRING)) AS chunk_id",
            "CAST(id AS INT) AS chunk",
            f"CAST(id DIV {g} AS INT) AS i",
            f"CAST(id % {g} AS INT) AS j",
            f"{dlit(b.min_x)} + CAST(id DIV {g} AS DOUBLE) * {sx} AS xmin",
            f"{dlit(b.min_x)} + CAST(id DIV {g} + 1 AS DOUBLE) * {sx} AS xmax",
            f"{dlit(b.min_y)} + CAST(id % {g} AS DOUBLE) * {sy} AS ymin",
            f"{dlit(b.min_y)} + CAST(id % {g} + 1 AS DOUBLE) * {sy} AS ymax",
        )

    def ordinal(self, chunk_id: str) -> int:
        i, j = (int(p) for p in chunk_id.split("_"))
        if not (0 <= i < self.size and 0 <= j < self.size):
            raise ValueError(f"chunk {chunk_id} is outside a {self.size}x{self.size} grid")
        return i * self.size + j

    def hull_sql(self, i0: int, i1: int, j0: int, j1: int) -> str:
        """x, y ranges that hold every point of the cells i0..i1, j0..j1 (and more).

        Cell edges and :meth:`assign` round differently in the last bit, so the ranges reach a hundredth
        of a cell further; the exact test is the assigned chunk.
        """
        b, mx, my = self.bounds, self.x_step / 100, self.y_step / 100
        return (f"x BETWEEN {dlit(b.min_x + i0 * self.x_step - mx)} AND {dlit(b.min_x + (i1 + 1) * self.x_step + mx)} AND "
                f"y BETWEEN {dlit(b.min_y + j0 * self.y_step - my)} AND {dlit(b.min_y + (j1 + 1) * self.y_step + my)}")

    def first_sql(self, n: int) -> str:
        """The points of the first ``n`` chunks in grid order: exact test plus pushable ranges."""
        last = max(n - 1, 0)
        j1 = last if last < self.size else self.size - 1
        return f"{self.hull_sql(0, last // self.size, 0, j1)} AND {self.chunk_sql()} < {int(n)}"

    def reach_sql(self, min_x, max_x, min_y, max_y, chunk: str = "chunk") -> str:
        """Chunks that a box may touch, as ranges on the ordinal's row and column, a cell to spare."""
        def span(lo, hi, origin: float, step: float) -> tuple[int, int]:
            if step <= 0:
                return 0, self.size - 1
            at = lambda v: int(max(-1, min(self.size, math.floor((v - origin) / step))))
            return (0 if lo is None else at(lo) - 1), (self.size - 1 if hi is None else at(hi) + 1)

        b = self.bounds
        (i0, i1), (j0, j1) = span(min_x, max_x, b.min_x, self.x_step), span(min_y, max_y, b.min_y, self.y_step)
        return f"{chunk} DIV {self.size} BETWEEN {i0} AND {i1} AND {chunk} % {self.size} BETWEEN {j0} AND {j1}"


def points_in_box(points: DataFrame, min_x: float | None = None, max_x: float | None = None,
                  min_y: float | None = None, max_y: float | None = None) -> DataFrame:
    """Spatial range scan (S1.2, S1.3): inclusive XY box, missing bounds are open.

    Only x, y, z are projected, and the comparisons are literal, so on a Parquet point
    table both reach the scan as ``PushedFilters`` and ``ReadSchema``.
    """
    parts = [f"{c} {op} {dlit(v)}" for c, op, v in
             (("x", ">=", min_x), ("x", "<=", max_x), ("y", ">=", min_y), ("y", "<=", max_y)) if v is not None]
    return points.where(" AND ".join(parts) or "true").select("x", "y", "z")


def chunk_occupancy(points: DataFrame, grid: Grid) -> DataFrame:
    """S2.1 + S2.2: every grid cell with its box and the number of valid points in it (0 if none).

    The per-chunk count is a partial/final aggregate (at most G^2 rows); joining it to the
    G^2-row grid is a join of two bounded tables.
    """
    counts = (grid.assign(points).where(f"{VALID_SQL} AND chunk IS NOT NULL")
              .groupBy("chunk").agg(F.expr("count(1) AS n_points")))
    return (grid.chunks(points.sparkSession).join(counts, "chunk", "left")
            .selectExpr("chunk_id", "i", "j", "xmin", "xmax", "ymin", "ymax",
                        "CAST(coalesce(n_points, 0) AS BIGINT) AS n_points"))
