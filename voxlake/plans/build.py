"""Composed voxel job: assign chunks -> reject invalid -> clean per chunk -> voxelize.

Physical shape (see ``explain``): two scans of the point source (one for the G^2-row chunk
stats, one for the voxels), a partial+final aggregate for the stats, a broadcast of them,
and a partial+final aggregate on ``(chunk, voxel_x, voxel_y, voxel_z)``. Only partial
aggregate rows cross the network; points are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from voxlake.operators.chunks import VALID_SQL, Bounds, Grid
from voxlake.operators.clean import Z_MAX_LIMIT, Z_MIN_LIMIT, chunk_z_stats, elevation_filter, sigma_filter
from voxlake.operators.recovery import points_of_chunks
from voxlake.operators.voxels import voxelize
from voxlake.schemas import VOXEL_COLUMNS


@dataclass(frozen=True)
class VoxelConfig:
    """Run options (the reference's command-line flags, as arguments)."""

    grid_size: int = 8
    voxel_size: float = 2.0
    filter_outliers: bool = True
    z_min: float = Z_MIN_LIMIT
    z_max: float = Z_MAX_LIMIT
    max_chunks: int | None = None
    #: A chunk fails if its in-range share is below this part of the whole read's (None: no such rule).
    share_floor: float | None = None

    def __post_init__(self):
        if int(self.grid_size) < 1:
            raise ValueError(f"grid_size must be >= 1, got {self.grid_size}")
        if not float(self.voxel_size) > 0:
            raise ValueError(f"voxel_size must be > 0, got {self.voxel_size}")
        if self.z_min > self.z_max:
            raise ValueError("z_min must not exceed z_max")
        if self.max_chunks is not None and int(self.max_chunks) < 0:
            raise ValueError("max_chunks must be >= 0")

    def with_(self, **kw) -> "VoxelConfig":
        return replace(self, **kw)


def usable_points(assigned: DataFrame) -> DataFrame:
    """Valid points that fall in a chunk, projected to what cleaning and aggregation read."""
    return assigned.where(f"{VALID_SQL} AND chunk IS NOT NULL").select("chunk", "x", "y", "z")


def chunk_voxels(assigned: DataFrame, grid: Grid, cfg: VoxelConfig, stats: DataFrame | None = None) -> DataFrame:
    """Voxel rows (8 columns + ``chunk_id``) of already chunk-assigned points.

    ``stats`` may be a precomputed chunk profile with ``chunk, n_z, mean_z, std_pop_z`` (the ingest
    job reads it back); otherwise it is derived. Points of chunks without a row in it are left out.
    """
    pts = usable_points(assigned)
    if cfg.filter_outliers:
        pts = elevation_filter(pts, cfg.z_min, cfg.z_max)
        st = chunk_z_stats(pts) if stats is None else stats.select("chunk", "n_z", "mean_z", "std_pop_z")
        pts = sigma_filter(pts, st, "chunk", grid.n_chunks)
    elif stats is not None:
        pts = points_of_chunks(pts, stats, grid.n_chunks)
    vox = voxelize(pts, cfg.voxel_size, by=["chunk"])
    return vox.select(*VOXEL_COLUMNS, grid.chunk_id("chunk").alias("chunk_id"))


def voxelize_points(points: DataFrame, cfg: VoxelConfig, bounds: Bounds | None = None) -> DataFrame:
    """Whole batch path: header bounds (one small job unless given), grid, optional first-N
    chunk limit, cleaning and voxel aggregation. Returns a lazy DataFrame.

    The first N chunks are known before the job, so they are a literal predicate whose x, y
    ranges reach the scan; nothing is joined or shuffled for them.
    """
    bounds = bounds or Bounds.of(points)
    grid = Grid(bounds, cfg.grid_size)
    if cfg.max_chunks is not None:
        points = points.where(grid.first_sql(int(cfg.max_chunks)))
    return chunk_voxels(grid.assign(points), grid, cfg)


def profile_voxels(points: DataFrame, voxel_size: float, filter_outliers: bool = True,
                   z_min: float = Z_MIN_LIMIT, z_max: float = Z_MAX_LIMIT) -> DataFrame:
    """The whole input as one chunk: clean (range + 3 sigma over all points) and voxelize.

    The single-call form of the voxel operator (S4.1 with S2.3-S2.5): 8 columns, no chunk id.
    The stats are one global aggregate (one broadcast row); the voxel aggregate is partial +
    final on the voxel key, so no single task ever holds the whole input.
    """
    pts = points.where(VALID_SQL).selectExpr("0 AS chunk", "x", "y", "z")
    if filter_outliers:
        if z_min > z_max:
            raise ValueError("z_min must not exceed z_max")
        pts = elevation_filter(pts, z_min, z_max)
        pts = sigma_filter(pts, chunk_z_stats(pts), "chunk", 1)
    return voxelize(pts.drop("chunk"), voxel_size, by=[])
