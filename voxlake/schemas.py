"""Fixed schemas of the point input and of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the voxel table, as the reference stores it.
VOXEL_COLUMNS = [
    "voxel_x", "voxel_y", "voxel_z",
    "point_count", "mean_z", "std_z", "min_z", "max_z",
]
INDEX_COLUMNS = ["voxel_x", "voxel_y", "voxel_z"]

POINT_SCHEMA = T.StructType([
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("z", T.DoubleType()),
])

VOXEL_SCHEMA = T.StructType([
    T.StructField("voxel_x", T.LongType()),
    T.StructField("voxel_y", T.LongType()),
    T.StructField("voxel_z", T.LongType()),
    T.StructField("point_count", T.LongType()),
    T.StructField("mean_z", T.DoubleType()),
    T.StructField("std_z", T.DoubleType()),
    T.StructField("min_z", T.DoubleType()),
    T.StructField("max_z", T.DoubleType()),
])

# Stored voxel rows carry the run that wrote them (NULL for rows appended outside a run) and
# the chunk they were aggregated in (physical partition column).
STORED_VOXEL_SCHEMA = T.StructType(VOXEL_SCHEMA.fields + [T.StructField("run_seq", T.LongType()),
                                                          T.StructField("chunk_id", T.StringType())])

OUTCOME_SCHEMA = T.StructType([
    T.StructField("run_seq", T.LongType()),
    T.StructField("chunk_id", T.StringType()),
    T.StructField("expected_points", T.LongType()),
    T.StructField("points_read", T.LongType()),
    T.StructField("points_rejected", T.LongType()),
    T.StructField("points_kept", T.LongType()),
    T.StructField("voxels", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])

# Partial states of the table reads: one row per run (or load) and chunk, merged when read.
STATE_FIELDS = [T.StructField(n, T.LongType()) for n in ("voxels", "points", "x_min", "x_max", "y_min", "y_max", "z_min", "z_max")] + [
    T.StructField(n, T.DoubleType()) for n in ("lowest", "highest", "sum_mean_z")]
STATE_SCHEMA = T.StructType(STATE_FIELDS + [T.StructField("run_seq", T.LongType()), T.StructField("chunk_id", T.StringType())])
LOAD_SCHEMA = T.StructType(STATE_FIELDS + [T.StructField("load", T.StringType()), T.StructField("chunk_id", T.StringType())])

# One row per published run; readers follow it.
COMMIT_SCHEMA = T.StructType([
    T.StructField("run_seq", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

METADATA_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("version", T.LongType()),
])

# Chunk outcome states.
STATUS_OK = "ok"
STATUS_EMPTY = "empty"
STATUS_FAILED = "failed"
# Kinds of a published run: a full run replaces the table, a resume adds to it.
FULL, RESUME = "full", "resume"
