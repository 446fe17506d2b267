"""Grid, chunk assignment and box scans (S1.1, S1.2, S2.1, S2.2, S2.11, S3.4)."""

import math
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, make_points, plan_text
from voxlake.operators.chunks import Bounds, Grid, chunk_occupancy, points_bounds, points_in_box
from voxlake.operators.recovery import select_chunks
from voxlake.sources.points import lineitem_points, write_points


def test_grid_ids_and_boxes(spark):
    g = Grid(Bounds(0.0, 10.0, 100.0, 120.0), 2)
    rows = g.chunks(spark).orderBy("chunk").collect()
    assert [r.chunk_id for r in rows] == ["0_0", "0_1", "1_0", "1_1"]      # i over x outer, j over y inner
    r01 = rows[1]
    assert (r01.xmin, r01.xmax, r01.ymin, r01.ymax) == (0.0, 5.0, 110.0, 120.0)


def test_edges_one_chunk_each(spark):
    """Inner edges go to the upper cell (half-open), the outer maximum to the last cell."""
    g = Grid(Bounds(0.0, 10.0, 0.0, 10.0), 2)
    pts = make_points(spark, [0.0, 5.0, 10.0, 4.999], [0.0, 5.0, 10.0, 9.0], [1.0] * 4)
    got = [r.cid for r in g.assign(pts).select(g.chunk_id("chunk").alias("cid"), "x").orderBy("x").collect()]
    assert got == ["0_0", "0_1", "1_1", "1_1"]


def test_zero_extent_uses_cell_zero(spark):
    g = Grid(Bounds(3.0, 3.0, 1.0, 5.0), 4)
    pts = make_points(spark, [3.0, 3.0], [1.0, 5.0], [0.0, 0.0])
    assert [r.chunk for r in g.assign(pts).orderBy("y").collect()] == [0, 3]


def test_every_point_in_one_chunk_and_range_join_cross_check(spark):
    """S3.4: arithmetic assignment equals a range join of points with half-open boxes, where the steps are
    exact; on a grid with rounded edges the two may differ by a last bit, and the hull still holds the point."""
    xs = [float(v) for v in range(0, 33)]
    pts = make_points(spark, [x for x in xs for _ in xs], [y for _ in xs for y in xs], [1.0] * len(xs) ** 2)
    g = Grid(Bounds(0.0, 32.0, 0.0, 32.0), 8)
    occ = chunk_occupancy(pts, g)
    assert occ.agg(F.sum("n_points")).first()[0] == len(xs) ** 2
    last_x, last_y = F.col("i") == g.size - 1, F.col("j") == g.size - 1
    inside = ((F.col("x") >= F.col("xmin")) & ((F.col("x") < F.col("xmax")) | (last_x & (F.col("x") <= F.col("xmax"))))
              & (F.col("y") >= F.col("ymin")) & ((F.col("y") < F.col("ymax")) | (last_y & (F.col("y") <= F.col("ymax")))))
    joined = pts.join(F.broadcast(g.chunks(spark)), inside).groupBy("chunk_id").count()
    assert {r.chunk_id: r.n_points for r in occ.collect()} == {r.chunk_id: r["count"] for r in joined.collect()}


@pytest.mark.parametrize("size", [7, 50])
def test_hull_holds_every_point_of_its_cells(spark, size):
    """Bounds 0..460 and steps that round: points on and beside every cell edge lie in the hull of their
    assigned chunk, for single cells and for the first N chunks."""
    g = Grid(Bounds(0.0, 460.0, 0.0, 460.0), size)
    edges = sorted({v for k in range(size + 1) for e in (k * g.x_step, 460.0 * k / size) for v in
                    (e, math.nextafter(e, -1.0), math.nextafter(e, 999.0)) if 0.0 <= v <= 460.0})
    pts = make_points(spark, edges, edges, [1.0] * len(edges))
    rows = g.assign(pts).collect()
    for r in rows:
        i, j = divmod(r.chunk, size)
        x0, x1, y0, y1 = (float(v.rstrip("D")) for v in re.findall(r"[-0-9.e]+D", g.hull_sql(i, i, j, j)))
        assert x0 <= r.x <= x1 and y0 <= r.y <= y1
    for n in (1, size - 1, size, size * 3 + 1, size * size):
        got = g.assign(pts.where(g.first_sql(n))).count()
        assert got == sum(r.chunk < n for r in rows)


def test_points_bounds_header(spark):
    pts = make_points(spark, [1.0, 4.0, float("nan")], [2.0, -3.0, 0.0], [5.0, 6.0, 1.0])
    r = points_bounds(pts).first()
    assert (r.min_x, r.max_x, r.min_y, r.max_y, r.min_z, r.max_z, r.point_count) == (1.0, 4.0, -3.0, 2.0, 5.0, 6.0, 3)


def test_points_in_box_inclusive_and_pushed(spark, tmp_path):
    pts = make_points(spark, [1.0, 2.0, 3.0], [1.0, 2.0, 3.0], [0.0, 0.0, 0.0])
    path = str(tmp_path / "pts")
    pts.write.parquet(path)
    got = points_in_box(spark.read.parquet(path), 2.0, 3.0, 1.0, 2.0)
    assert [(r.x, r.y) for r in got.collect()] == [(2.0, 2.0)]
    plan = plan_text(got)
    assert "PushedFilters" in plan and "GreaterThanOrEqual(x,2.0)" in plan and "LessThanOrEqual(y,2.0)" in plan


def test_first_n_chunks_after_resume_filter(spark):
    g = Grid(Bounds(0.0, 1.0, 0.0, 1.0), 3)
    failed = spark.createDataFrame([("2_1",), ("0_2",), ("1_0",)], "chunk_id string")
    got = [r.chunk_id for r in select_chunks(g.chunks(spark), failed, 2).collect()]
    assert got == ["0_2", "1_0"]
    assert select_chunks(g.chunks(spark), None, 4).count() == 4


def test_read_points_any_format_same_voxels(spark, tmp_path):
    """S1.1-S1.3 re-aimed: points from CSV / JSON / Parquet with a declared schema give the same voxels."""
    from voxlake.plans.build import VoxelConfig, voxelize_points
    from voxlake.sources.points import read_points
    src = lineitem_points(spark, SF_SMALL).selectExpr("x AS east", "y AS north", "z AS elev")
    schema = "east DOUBLE, north DOUBLE, elev DOUBLE"
    for fmt in ("csv", "json", "parquet"):
        src.write.format(fmt).option("header", "true").save(str(tmp_path / fmt))
    cfg = VoxelConfig(grid_size=4, voxel_size=50.0)
    results = []
    for fmt in ("csv", "json", "parquet"):
        pts = read_points(spark, str(tmp_path / fmt), fmt=fmt, schema=schema, x="east", y="north", z="elev",
                          header="true")
        assert pts.columns == ["x", "y", "z"]
        results.append(sorted(tuple(r) for r in voxelize_points(pts, cfg).collect()))
    assert results[0] == results[1] == results[2] and len(results[0]) > 0


def test_grid_size_bounds():
    for bad in (0, 1001):
        with pytest.raises(ValueError):
            Grid(Bounds(0.0, 1.0, 0.0, 1.0), bad)
    assert Grid(Bounds(0.0, 1.0, 0.0, 1.0), 1000).n_chunks == 1000 ** 2


def test_staged_points_prune_and_keep_every_row(spark, tmp_path):
    """Staged layout: all rows come back (unplaced ones too), the manifest counts them, a box read opens
    only its folders and pushes x and y, and gives the plain box's rows on a grid with rounded edges."""
    xs = [v * 460.0 / 70 for v in range(71)]
    pts = make_points(spark, [*xs, float("nan"), None], [*xs[::-1], 1.0, 2.0], [1.0] * 73)
    g = Grid(Bounds(0.0, 460.0, 0.0, 460.0), 7)
    staged = write_points(pts, str(tmp_path / "staged"), g)
    assert staged.grid == g and staged.points().count() == 73
    want = {r.chunk: r["count"] for r in g.assign(pts).where("chunk IS NOT NULL").groupBy("chunk").count().collect()}
    assert {g.ordinal(r.chunk_id): r.expected_points for r in staged.manifest().collect()} == want
    for box in ((66.0, 200.0, 100.0, 460.0), (460.0 / 7, 2 * 460.0 / 7, None, None), (None, None, 460.0, None), (500.0, None, None, None)):
        a = sorted(repr((r.x, r.y)) for r in staged.in_box(*box).collect())
        assert a == sorted(repr((r.x, r.y)) for r in points_in_box(pts, *box).collect())
    plan = plan_text(staged.in_box(66.0, 70.0, 100.0, 120.0))
    assert "GreaterThanOrEqual(x,66.0)" in plan and re.search(r"PartitionFilters: \[.*chunk", plan)


def test_first_chunks_need_no_join_and_no_point_exchange(spark):
    from voxlake.plans.build import VoxelConfig, voxelize_points
    pts = lineitem_points(spark, SF_SMALL)
    plan = plan_text(voxelize_points(pts, VoxelConfig(grid_size=8, voxel_size=50.0, max_chunks=3, filter_outliers=False)))
    assert "Join" not in plan and plan.count("Exchange") == 2       # the partial voxel rows (once, named twice)
    assert sum(voxelize_points(pts, VoxelConfig(grid_size=8, voxel_size=50.0, max_chunks=n)).count() for n in (0,)) == 0


def test_building_a_plan_runs_no_job(spark):
    """With bounds given, nothing upstream runs before an action (an aggregate would otherwise run twice)."""
    from voxlake.plans.build import VoxelConfig, voxelize_points
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "plan-only")
    pts = lineitem_points(spark, SF_SMALL).groupBy("x", "y").agg(F.max("z").alias("z"))
    voxelize_points(pts, VoxelConfig(grid_size=4, voxel_size=50.0), Bounds(0.0, 300.0, -2000.0, 3000.0))
    assert list(sc.statusTracker().getJobIdsForGroup("plan-only")) == []
    sc.setJobGroup("", "")
