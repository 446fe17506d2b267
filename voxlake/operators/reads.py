"""Read queries over a voxel table (S2.7-S2.10, S2.14, S4.4-S4.8, S4.11, S6.1-S6.3).

Every function takes a voxel DataFrame (stored or freshly computed) and returns a
DataFrame. Global aggregates reduce map-side to one partial row per task; top-k and box
results plan as TakeOrderedAndProject, so no full sort of the table happens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxlake.functions import floor_bound, round_half_away, trunc_index
from voxlake.schemas import INDEX_COLUMNS, VOXEL_COLUMNS

# Parameter ranges and defaults of the reference's query endpoints.
DENSEST_DEFAULT, DENSEST_MAX = 10, 100
BOX_DEFAULT, BOX_MAX = 1000, 50000
REPORT_TOP = 5


def _check_limit(limit: int, hi: int, what: str) -> int:
    n = int(limit)
    if not 1 <= n <= hi:
        raise ValueError(f"{what} limit must be in 1..{hi}, got {limit}")
    return n


def _order(voxels: DataFrame) -> list[Column]:
    """Deterministic order: index columns, then the chunk (R16 tie-break)."""
    cols = [F.col(c) for c in INDEX_COLUMNS]
    if "chunk_id" in voxels.columns:
        cols.append(F.col("chunk_id"))
    return cols


def _out_cols(voxels: DataFrame) -> list[str]:
    return VOXEL_COLUMNS + (["chunk_id"] if "chunk_id" in voxels.columns else [])


def voxel_stats(voxels: DataFrame) -> DataFrame:
    """S4.4: rows (partial voxels included, R8), points, index ranges. Empty table -> NULL sums."""
    return voxels.selectExpr(
        "count(1) AS total_voxels", "sum(point_count) AS total_points",
        "min(voxel_x) AS x_min", "max(voxel_x) AS x_max",
        "min(voxel_y) AS y_min", "max(voxel_y) AS y_max",
        "min(voxel_z) AS z_min", "max(voxel_z) AS z_max",
    )


def voxel_summary(voxels: DataFrame) -> DataFrame:
    """S4.5: voxel rows, points represented, mean points per voxel row."""
    return voxels.selectExpr("count(1) AS voxel_count", "sum(point_count) AS total_points",
                             "avg(point_count) AS avg_points_per_voxel")


def voxel_extents(voxels: DataFrame) -> DataFrame:
    """S4.6: min/max of each voxel index."""
    return voxels.selectExpr(*[f"{fn}({c}) AS {fn}_{c}" for c in INDEX_COLUMNS for fn in ("min", "max")])


def elevation_profile(voxels: DataFrame) -> DataFrame:
    """S4.7: lowest min_z, highest max_z, and the *unweighted* mean of voxel means."""
    return voxels.selectExpr("min(min_z) AS min_elev", "max(max_z) AS max_elev", "avg(mean_z) AS avg_elev")


def row_count(voxels: DataFrame) -> DataFrame:
    """S4.8: ``SELECT COUNT(*)``."""
    return voxels.selectExpr("count(1) AS row_count")


# -- the same reads from partial states -----------------------------------------------------------
# A state is what the reads need of one chunk's rows; states add up or take extremes, so a read of a stored
# table merges a row for each chunk and run and opens no voxel file.

def chunk_states(voxels: DataFrame) -> DataFrame:
    """Partial states of voxel rows by chunk: counts, index and elevation extremes, sum of the means."""
    return voxels.groupBy("chunk_id").agg(*[F.expr(e) for e in (
        "count(1) AS voxels", "sum(point_count) AS points", *(f"{fn}(voxel_{c}) AS {c}_{fn}" for c in "xyz" for fn in ("min", "max")),
        "min(min_z) AS lowest", "max(max_z) AS highest", "sum(mean_z) AS sum_mean_z")])


def stats_of(states: DataFrame) -> DataFrame:
    """S4.4 from states; equal to :func:`voxel_stats` of their rows."""
    return states.selectExpr("coalesce(sum(voxels), 0) AS total_voxels", "sum(points) AS total_points",
                             *(f"{fn}({c}_{fn}) AS {c}_{fn}" for c in "xyz" for fn in ("min", "max")))


def summary_of(states: DataFrame) -> DataFrame:
    """S4.5 from states."""
    return states.selectExpr("coalesce(sum(voxels), 0) AS voxel_count", "sum(points) AS total_points",
                             "CAST(sum(points) AS DOUBLE) / nullif(sum(voxels), 0) AS avg_points_per_voxel")


def extents_of(states: DataFrame) -> DataFrame:
    """S4.6 from states."""
    return states.selectExpr(*[f"{fn}({c}_{fn}) AS {fn}_voxel_{c}" for c in "xyz" for fn in ("min", "max")])


def profile_of(states: DataFrame) -> DataFrame:
    """S4.7 from states; the mean of voxel means stays unweighted."""
    return states.selectExpr("min(lowest) AS min_elev", "max(highest) AS max_elev", "sum(sum_mean_z) / nullif(sum(voxels), 0) AS avg_elev")


def count_of(states: DataFrame) -> DataFrame:
    """S4.8 from states."""
    return states.selectExpr("coalesce(sum(voxels), 0) AS row_count")


def densest_by_chunk(voxels: DataFrame, n: int = DENSEST_MAX) -> DataFrame:
    """The ``n`` densest rows of each chunk, in the order of :func:`densest_voxels`.

    The rank's limit works before the shuffle, so of a chunk with a third of all rows each task sends ``n``.
    """
    w = Window.partitionBy("chunk_id").orderBy(F.col("point_count").desc(), *_order(voxels))
    return voxels.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).drop("rank")


def densest_voxels(voxels: DataFrame, limit: int = DENSEST_DEFAULT) -> DataFrame:
    """S6.1: top-N voxel rows by point count (N in 1..100), ties broken by key."""
    n = _check_limit(limit, DENSEST_MAX, "densest")
    return voxels.orderBy(F.col("point_count").desc(), *_order(voxels)).limit(n).select(*_out_cols(voxels))


def densest_report(voxels: DataFrame, limit: int = REPORT_TOP, digits: int = 2) -> DataFrame:
    """S6.2: top-5 report with mean_z and std_z rounded to two decimals (binary-product rounding)."""
    top = densest_voxels(voxels, limit)
    return top.select(*INDEX_COLUMNS, "point_count",
                      round_half_away("mean_z", digits).alias("mean_z"),
                      round_half_away("std_z", digits).alias("std_z"))


def index_bounds(min_x=None, max_x=None, min_y=None, max_y=None, min_z=None, max_z=None,
                 is_voxel_coords: bool = False, voxel_size: float = 2.0) -> dict:
    """S2.8 / S2.9: physical bounds are floored by the voxel size, raw index bounds truncated."""
    raw = dict(min_x=min_x, max_x=max_x, min_y=min_y, max_y=max_y, min_z=min_z, max_z=max_z)
    if is_voxel_coords:
        return {k: trunc_index(v) for k, v in raw.items()}
    if not float(voxel_size) > 0:
        raise ValueError(f"voxel_size must be > 0, got {voxel_size}")
    return {k: floor_bound(v, voxel_size) for k, v in raw.items()}


def box_predicate(bounds: dict) -> str:
    """S2.7: AND of the given inclusive bounds on voxel indices; none given -> all rows."""
    parts = []
    for axis in ("x", "y", "z"):
        lo, hi = bounds.get(f"min_{axis}"), bounds.get(f"max_{axis}")
        if lo is not None:
            parts.append(f"voxel_{axis} >= {int(lo)}")
        if hi is not None:
            parts.append(f"voxel_{axis} <= {int(hi)}")
    return " AND ".join(parts) or "true"


def box_state_predicate(bounds: dict) -> str:
    """The states whose index extremes meet the box; others hold none of its rows."""
    tests = [f"{c}_max >= {int(v)}" for c in "xyz" if (v := bounds.get(f"min_{c}")) is not None]
    tests += [f"{c}_min <= {int(v)}" for c in "xyz" if (v := bounds.get(f"max_{c}")) is not None]
    return " AND ".join(tests) or "true"


def ordered_box(voxels: DataFrame, bounds: dict, limit: int) -> DataFrame:
    """The first ``limit`` rows of a box of index bounds, in index order (S6.3)."""
    return voxels.where(box_predicate(bounds)).orderBy(*_order(voxels)).limit(limit).select(*_out_cols(voxels))


def voxels_in_box(voxels: DataFrame, min_x=None, max_x=None, min_y=None, max_y=None,
                  min_z=None, max_z=None, is_voxel_coords: bool = False, voxel_size: float = 2.0,
                  limit: int = BOX_DEFAULT) -> DataFrame:
    """S2.7-S2.9 + S6.3: voxels whose cell range reaches the box, ordered by index, first ``limit``.

    Bounds are turned into BIGINT literals on the driver, so on a stored table the
    comparisons reach the Parquet scan as pushed filters and skip row groups of the
    index-sorted layout.
    """
    n = _check_limit(limit, BOX_MAX, "box")
    b = index_bounds(min_x, max_x, min_y, max_y, min_z, max_z, is_voxel_coords, voxel_size)
    return ordered_box(voxels, b, n)


def voxels_between(voxels: DataFrame, x_lo: int, x_hi: int, y_lo: int, y_hi: int) -> DataFrame:
    """S2.10: ``voxel_x BETWEEN .. AND voxel_y BETWEEN ..`` (no limit)."""
    return voxels.where(f"voxel_x BETWEEN {int(x_lo)} AND {int(x_hi)} AND "
                        f"voxel_y BETWEEN {int(y_lo)} AND {int(y_hi)}").select(*_out_cols(voxels))


# Metadata keys and the defaults the reference's stats endpoint falls back to.
METADATA_DEFAULTS = {
    "voxel_size": "2.0",
    "grid_size": "8",
    "source": "",
    "point_count": "0",
    "filter_outliers": "True",
    "failed_chunks": "[]",
}


def run_summary(voxels: DataFrame | None, metadata: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """S4.11: table stats (of ``voxels``, or the given one row) plus the typed run configuration with defaults.

    ``metadata`` is the latest (key, value) view. Each setting is a scalar subquery over
    it, so nothing is joined and nothing is fetched to the driver.
    """
    def setting(key: str) -> Column:
        v = metadata.agg(F.max(F.when(F.col("key") == key, F.col("value"))).alias(key)).scalar()
        return F.coalesce(v, F.lit(METADATA_DEFAULTS[key]))

    # Bad JSON parses to NULL and counts as an empty list (S8.8).
    failed = F.coalesce(F.from_json(setting("failed_chunks"), "array<string>"),
                        F.array().cast("array<string>"))
    return (voxel_stats(voxels) if stats is None else stats).select(
        "*",
        setting("voxel_size").cast("double").alias("voxel_size_meters"),
        setting("grid_size").cast("int").alias("grid_size"),
        setting("source").alias("source"),
        setting("point_count").cast("long").alias("original_point_count"),
        (setting("filter_outliers") == F.lit("True")).alias("outliers_filtered"),
        F.size(failed).alias("failed_chunk_count"),
        F.to_json(failed).alias("failed_chunks"),
    )
