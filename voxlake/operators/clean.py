"""Elevation cleaning per chunk (S2.3, S2.4, S2.5, S3.3, S4.2; rules R1-R4, R9, R10).

The 3-sigma rule needs the mean and population std of each chunk's range survivors. Those
come from one partial/final aggregate (only per-task partial states are shuffled, so a
chunk holding a third of all points costs nothing extra), and the result -- at most G^2
rows -- is broadcast back to the points. No point is shuffled for cleaning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.functions import dlit

# Fixed values of the reference's cleaning rule.
Z_MIN_LIMIT = -50.0
Z_MAX_LIMIT = 150.0
SIGMA_K = 3.0
MIN_SIGMA = 0.01

# Largest stats table we broadcast: rows are (chunk int, n long, mean, std double), ~40 bytes
# each, so this bound keeps the broadcast under ~40 MB. Grids are bounded by it (``MAX_GRID``); a
# caller with other keys passes its own bound, and above it the join is left to Spark.
MAX_BROADCAST_CHUNKS = 1_000_000


def maybe_broadcast(df: DataFrame, row_bound: int, limit: int = MAX_BROADCAST_CHUNKS) -> DataFrame:
    """Broadcast ``df`` only when its row count is provably at most ``limit``."""
    return F.broadcast(df) if row_bound <= limit else df


def in_range(lo: float = Z_MIN_LIMIT, hi: float = Z_MAX_LIMIT) -> Column:
    """Inclusive absolute elevation window (R2). NaN fails ``z <= hi``."""
    return F.expr(f"z BETWEEN {dlit(lo)} AND {dlit(hi)}")


def elevation_filter(points: DataFrame, lo: float = Z_MIN_LIMIT, hi: float = Z_MAX_LIMIT) -> DataFrame:
    """S2.3: keep points whose z lies in [lo, hi]."""
    return points.where(in_range(lo, hi))


def chunk_z_stats(points: DataFrame, key: str = "chunk") -> DataFrame:
    """S4.2: per chunk count, mean and **population** std of z."""
    return points.groupBy(key).agg(
        F.count("z").alias("n_z"),
        F.avg("z").alias("mean_z"),
        F.stddev_pop("z").alias("std_pop_z"),
    )


def sigma_keep(k: float = SIGMA_K, min_sigma: float = MIN_SIGMA) -> Column:
    """Apply 3-sigma only with more than one survivor and std > 0.01; bound inclusive."""
    return F.expr(f"n_z <= 1 OR std_pop_z <= {dlit(min_sigma)} OR abs(z - mean_z) <= {dlit(k)} * std_pop_z")


def sigma_filter(points: DataFrame, stats: DataFrame, key: str = "chunk",
                 chunk_bound: int = MAX_BROADCAST_CHUNKS) -> DataFrame:
    """S2.4 / S3.3: join the chunk stats back (broadcast when bounded) and keep points within 3 sigma.

    ``points`` must already be the range survivors the stats were computed from.
    """
    joined = points.join(maybe_broadcast(stats, chunk_bound), on=key, how="inner")
    return joined.where(sigma_keep()).drop("n_z", "mean_z", "std_pop_z")


def clean_points(points: DataFrame, filter_outliers: bool = True, z_min: float = Z_MIN_LIMIT,
                 z_max: float = Z_MAX_LIMIT, key: str = "chunk",
                 chunk_bound: int = MAX_BROADCAST_CHUNKS) -> DataFrame:
    """S2.5: range filter then per-chunk 3-sigma, or nothing at all when the toggle is off."""
    if not filter_outliers:
        return points
    if z_min > z_max:
        raise ValueError(f"z_min {z_min} > z_max {z_max}")
    survivors = elevation_filter(points, z_min, z_max)
    return sigma_filter(survivors, chunk_z_stats(survivors, key), key, chunk_bound)
