"""Voxel index and voxel aggregation (S2.6, S2.13, S4.1; rules R5-R7, R11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.functions import dlit
from voxlake.schemas import INDEX_COLUMNS, VOXEL_COLUMNS


def _check_size(voxel_size: float) -> float:
    size = float(voxel_size)
    if not size > 0:
        raise ValueError(f"voxel_size must be > 0, got {voxel_size}")
    return size


def voxel_index(points: DataFrame, voxel_size: float) -> DataFrame:
    """S2.6: add ``voxel_x/y/z = floor(c / size)`` as BIGINT."""
    size = _check_size(voxel_size)
    return points.select("*", *[F.expr(f"floor({c} / {dlit(size)}) AS voxel_{c}") for c in ("x", "y", "z")])


def voxel_aggregates():
    """S4.1 aggregates of z: count, mean, sample std (0.0 for one point, R6/S2.13), min, max."""
    return [F.expr(e) for e in (
        "count(z) AS point_count",
        "avg(z) AS mean_z",
        "coalesce(stddev_samp(z), 0.0D) AS std_z",
        "min(z) AS min_z",
        "max(z) AS max_z",
    )]


def voxelize(points: DataFrame, voxel_size: float, by: list[str] | None = None) -> DataFrame:
    """S4.1: group points into cubic voxels of edge ``voxel_size`` and profile their elevation.

    ``by`` are extra grouping keys kept in front of the voxel columns; by default a
    ``chunk_id`` or ``chunk`` column present in ``points`` is used, because the reference
    aggregates within a chunk and never merges a voxel that straddles a chunk edge (R7).
    A partial aggregate runs before the shuffle, so a voxel or chunk with a huge share of
    the points is reduced map-side. Empty input gives an empty frame with the schema (R11).
    """
    keys = by if by is not None else [c for c in ("chunk_id", "chunk") if c in points.columns]
    indexed = voxel_index(points, voxel_size)
    return indexed.groupBy(*keys, *INDEX_COLUMNS).agg(*voxel_aggregates()).select(*keys, *VOXEL_COLUMNS)
