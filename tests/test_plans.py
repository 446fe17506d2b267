"""Physical-plan checks: pruning, pushdown, broadcast of bounded stats, partial aggregation, no Python."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, make_points, plan_text
from voxlake.operators.chunks import Bounds, Grid
from voxlake.operators.reads import densest_voxels, voxels_in_box
from voxlake.plans.build import VoxelConfig, chunk_voxels, voxelize_points
from voxlake.plans.catalog import LINEITEM, QUERIES
from voxlake.sources.points import lineitem_points
from voxlake.sources.store import read_voxel_layout, write_voxel_layout


@pytest.fixture(scope="module")
def flagship_plan(spark):
    return plan_text(QUERIES["voxelize_clean"](spark, SF_MID))


def test_scan_reads_only_needed_columns(flagship_plan):
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz>" \
        in flagship_plan


def test_stats_are_broadcast_and_points_not_shuffled_for_cleaning(flagship_plan):
    assert "BroadcastHashJoin" in flagship_plan and "BroadcastExchange" in flagship_plan
    assert "SortMergeJoin" not in flagship_plan


def test_aggregates_are_partial_then_final(flagship_plan):
    assert "partial_stddev_samp(z" in flagship_plan and "partial_stddev_pop(z" in flagship_plan
    assert flagship_plan.count("HashAggregate") >= 4


def test_no_python_in_plans(flagship_plan, spark):
    for name in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert name not in flagship_plan
    outcome_plan = plan_text(QUERIES["chunk_outcomes"](spark, SF_MID))
    assert "Python" not in outcome_plan


def test_stored_box_query_prunes_and_pushes(spark, tmp_path):
    pts = lineitem_points(spark, SF_MID)
    path = str(tmp_path / "vox")
    write_voxel_layout(voxelize_points(pts, LINEITEM.config()), path)
    vox = read_voxel_layout(spark, path)
    q = voxels_in_box(vox, min_x=10, max_x=12, min_y=5, max_y=20, is_voxel_coords=True, limit=50)
    plan = plan_text(q)
    assert "TakeOrderedAndProject" in plan
    assert "GreaterThanOrEqual(voxel_x,10)" in plan and "LessThanOrEqual(voxel_y,20)" in plan
    top = plan_text(densest_voxels(vox, 10))
    assert "TakeOrderedAndProject" in top and "Sort " not in top.split("== Physical Plan ==")[1].split("\n\n")[0]


def test_hot_chunk_is_reduced_map_side(spark):
    """A chunk holding most of the points is cleaned and aggregated without collecting it anywhere:
    the plan groups by (chunk, voxel) with a partial aggregate before the exchange."""
    xs = [0.5 + (k % 7) * 0.01 for k in range(3000)] + [float(k) for k in range(100)]
    ys = [0.5] * 3000 + [float(k % 10) * 10 for k in range(100)]
    zs = [float(k % 13) for k in range(3100)]
    pts = make_points(spark, xs, ys, zs)
    g = Grid(Bounds.of(pts), 4)
    vox = chunk_voxels(g.assign(pts), g, VoxelConfig(grid_size=4, voxel_size=1.0))
    plan = plan_text(vox)
    hot = g.assign(pts).groupBy("chunk").count().orderBy(F.desc("count")).first()["count"]
    assert hot >= 3000                                   # one chunk holds almost all points
    assert "Keys [4]: [chunk" in plan                      # grouped by (chunk, voxel_x, voxel_y, voxel_z)
    assert "partial_count(z" in plan and "hashpartitioning(chunk" in plan
    assert vox.agg(F.sum("point_count")).first()[0] == 3100


def test_resume_read_pushes_chunk_ranges(spark, tmp_path):
    """Resume reads x, y ranges around the failed chunks: they reach the Parquet scan, hold every point of
    the chunks, and leave others out."""
    path = str(tmp_path / "pts")
    lineitem_points(spark, SF_MID).write.parquet(path)
    pts = spark.read.parquet(path)
    g = Grid(Bounds.of(pts), 8)
    q = g.assign(pts.where(g.hull_sql(0, 1, 3, 5)))
    pushed = [line for line in plan_text(q).splitlines() if "PushedFilters" in line][0]
    assert "GreaterThanOrEqual(x," in pushed and "LessThanOrEqual(y," in pushed
    inside = "chunk DIV 8 BETWEEN 0 AND 1 AND chunk % 8 BETWEEN 3 AND 5"
    assert q.where(inside).count() == g.assign(pts).where(inside).count() < q.count() < pts.count()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_registered_query_plans_have_no_python(spark, key):
    """Every registered query stays JVM-side: no Python UDF, pandas or Python-row nodes in its plan."""
    plan = plan_text(QUERIES[key](spark, "/root/testdata/sf0.001"))
    for name in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF",
                 "ExistingRDD"):
        assert name not in plan, f"{key}: {name}"
