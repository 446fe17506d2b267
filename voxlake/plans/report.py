"""Verification report (S1.13, S1.14): the four check queries over a voxel table, one line each.

The queries stay DataFrames (S4.5, S4.6, S6.2, S4.7); only their one-row results and the five densest rows,
a fixed amount, come to the driver for printing. Numbers are formatted in Spark, so NULL sums of an
empty table stay NULL instead of failing (B5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.operators.reads import densest_report, elevation_profile, voxel_extents, voxel_summary
from voxlake.schemas import INDEX_COLUMNS


def as_json_rows(df: DataFrame) -> DataFrame:
    """S1.13: one JSON object per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def format_report(voxels: DataFrame) -> str:
    """``name: field=value ...`` lines: size, index ranges, z range, then the densest cells."""
    return format_tables(voxel_summary(voxels), voxel_extents(voxels), elevation_profile(voxels), densest_report(voxels, 5))


def format_tables(size: DataFrame, index: DataFrame, z: DataFrame, densest: DataFrame) -> str:
    """The same from the four results, however they were computed."""
    def line(name: str, df: DataFrame, digits: int) -> str:
        shown = df.select(*[F.format_number(c, 0 if kind == "bigint" else digits).alias(c) for c, kind in df.dtypes])
        return "\n".join(f"{name}: " + " ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in shown.collect())

    top = densest.withColumn("cell", F.concat_ws("/", *INDEX_COLUMNS)).drop(*INDEX_COLUMNS)
    cells = [f"dense cell {r.cell}: n={r.point_count} mean={r.mean_z} std={r.std_z}" for r in top.collect()]
    return "\n".join([line("size", size, 2), line("index", index, 0), line("z", z, 2), *cells])
