"""Read queries over a voxel table (S2.7-S2.10, S2.14, S4.4-S4.8, S4.11, S6.1-S6.3)."""

import math

import pytest

from voxlake.functions import floor_bound, trunc_index
from voxlake.operators.reads import (densest_report, densest_voxels, elevation_profile, index_bounds,
                                     row_count, run_summary, voxel_extents, voxel_stats, voxel_summary,
                                     voxels_between, voxels_in_box)
from voxlake.schemas import VOXEL_SCHEMA

# A table of another form: ties in the count, a voxel that two chunks hold, negative indexes, one very dense voxel.
# Columns: index, count, mean, std, min, max. What a read should give is computed from these rows in each test.
ROWS = [(vx, vy, vz, 3 * abs(vx) + vy * vy + (400 if vz == 7 else 0) + 1, 0.25 * vx - vz, 0.5 * (vy % 3), 0.25 * vx - vz - 1.5, 0.25 * vx - vz + 2.0)
        for vx, vy, vz in [(-4, 0, -1), (-4, 2, 7), (0, -3, 2), (0, 3, 2), (1, 1, 0), (1, 1, 0), (6, -1, -9), (6, 5, 4), (9, 0, 0), (-9, 0, 0)]]
N, POINTS = len(ROWS), sum(r[3] for r in ROWS)


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, VOXEL_SCHEMA)


def test_stats_of_two_rows(spark):
    rows = [(-6, 8, 33, 14, 1.0, 0.0, 1.0, 1.0), (9, 70, 410, 23, 2.0, 0.0, 2.0, 2.0)]
    st = voxel_stats(spark.createDataFrame(rows, VOXEL_SCHEMA)).first()
    assert (st.total_voxels, st.total_points) == (2, 37)
    assert (st.x_min, st.x_max, st.y_min, st.y_max, st.z_min, st.z_max) == (-6, 9, 8, 70, 33, 410)


def test_stats_and_summary(table):
    columns = list(zip(*ROWS))
    st = voxel_stats(table).first()
    assert tuple(st) == (N, POINTS, *(f(c) for c in columns[:3] for f in (min, max)))
    s = voxel_summary(table).first()
    assert (s.voxel_count, s.total_points) == (N, POINTS) and s.avg_points_per_voxel == pytest.approx(POINTS / N)
    assert tuple(voxel_extents(table).first()) == tuple(f(c) for c in columns[:3] for f in (min, max))
    p = elevation_profile(table).first()
    assert (p.min_elev, p.max_elev) == (min(columns[6]), max(columns[7]))
    assert p.avg_elev == pytest.approx(sum(columns[4]) / N)                # unweighted mean of means (R14)
    assert row_count(table).first().row_count == N


def test_densest_order_and_limits(table):
    order = sorted(ROWS, key=lambda r: (-r[3], *r[:3]))
    for n in (1, 4, N, 100):
        assert [tuple(r) for r in densest_voxels(table, n).collect()] == order[:n]
    for bad in (0, 101):
        with pytest.raises(ValueError):
            densest_voxels(table, bad)


def test_densest_ties_broken_by_key(spark):
    rows = [(3, 0, 0, 7, 1.0, 0.0, 1.0, 1.0), (1, 0, 0, 7, 1.0, 0.0, 1.0, 1.0), (2, 0, 0, 9, 1.0, 0.0, 1.0, 1.0)]
    top = densest_voxels(spark.createDataFrame(rows, VOXEL_SCHEMA), 3).collect()
    assert [r.voxel_x for r in top] == [2, 1, 3]


def test_report_rounding_matches_duckdb_round(spark):
    """S6.2: the report's 2-digit rounding equals DuckDB's round(v, 2) on the same doubles."""
    import duckdb
    import numpy as np
    from voxlake.functions import round_half_away
    vals = [1.005, 2.675, -1.125, 0.125, -0.005, 1.115, 12.345, -12.345, 0.0, 99.995] + \
        list(np.random.RandomState(7).uniform(-60, 160, 300).round(3))
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    ours = [r.r for r in df.select(round_half_away("v", 2).alias("r")).collect()]
    con = duckdb.connect()
    theirs = [r[0] for r in con.execute("SELECT round(v, 2) FROM (SELECT unnest(?::DOUBLE[]) AS v)",
                                        [[float(v) for v in vals]]).fetchall()]
    assert ours == theirs
    rows = [(0, 0, 0, 5, 1.005, 2.675, 1.0, 1.0), (1, 0, 0, 4, -1.125, 0.0, 1.0, 1.0)]
    rep = densest_report(spark.createDataFrame(rows, VOXEL_SCHEMA)).collect()
    assert [(r.mean_z, r.std_z) for r in rep] == [tuple(theirs[:2]), (theirs[2], 0.0)]


@pytest.mark.parametrize("size, lo, hi", [(2.0, -8.0, 2.9), (0.5, -0.1, 3.0), (3.0, 17.9, 27.0)])
def test_box_in_physical_coordinates(table, size, lo, hi):
    got = voxels_in_box(table, min_x=lo, max_x=hi, max_y=2 * size, voxel_size=size).collect()
    inside = [r for r in ROWS if math.floor(lo / size) <= r[0] <= math.floor(hi / size) and r[1] <= 2]
    assert [tuple(r) for r in got] == sorted(inside) and inside


def test_box_in_index_coordinates(table):
    got = voxels_in_box(table, min_x=-4.9, max_x=6.9, min_z=-0.5, is_voxel_coords=True).collect()
    assert [tuple(r) for r in got] == sorted(r for r in ROWS if -4 <= r[0] <= 6 and r[2] >= 0)


def test_box_without_bounds_is_ordered_and_limited(table):
    assert [tuple(r) for r in voxels_in_box(table).collect()] == sorted(ROWS)
    assert [tuple(r) for r in voxels_in_box(table, limit=4).collect()] == sorted(ROWS)[:4]
    for bad in (0, 50001):
        with pytest.raises(ValueError):
            voxels_in_box(table, limit=bad)


def test_bound_conversions():
    """R12 floors physical bounds; R13 truncates raw index bounds toward zero."""
    assert trunc_index(-1.5) == -1 and floor_bound(-1.5, 1.0) == -2
    b = index_bounds(min_x=-1.5, max_z=3.9, is_voxel_coords=True)
    assert b["min_x"] == -1 and b["max_z"] == 3 and b["max_x"] is None
    assert index_bounds(min_x=-1.5, voxel_size=1.0)["min_x"] == -2
    with pytest.raises(ValueError):
        index_bounds(min_x=1.0, voxel_size=0.0)


def test_between(table):
    got = sorted(tuple(r) for r in voxels_between(table, -4, 1, 0, 2).collect())
    assert got == sorted(r for r in ROWS if -4 <= r[0] <= 1 and 0 <= r[1] <= 2) and len(got) == 4


def test_run_summary_defaults_and_latest(spark, table):
    meta = spark.createDataFrame([("voxel_size", "1.25"), ("grid_size", "12"), ("source", "own://cloud"),
                                  ("point_count", "7301"), ("filter_outliers", "True"),
                                  ("failed_chunks", "[]")], "key string, value string")
    r = run_summary(table, meta).first()
    assert (r.total_voxels, r.total_points, r.voxel_size_meters, r.grid_size, r.source) == (N, POINTS, 1.25, 12, "own://cloud")
    assert r.original_point_count == 7301 and r.outliers_filtered is True and r.failed_chunk_count == 0
    empty = spark.createDataFrame([], "key string, value string")
    d = run_summary(table, empty).first()
    assert (d.voxel_size_meters, d.grid_size, d.source, d.original_point_count, d.outliers_filtered,
            d.failed_chunks) == (2.0, 8, "", 0, True, "[]")
    bad = spark.createDataFrame([("failed_chunks", "not json"), ("filter_outliers", "False")], "key string, value string")
    b = run_summary(table, bad).first()
    assert b.failed_chunk_count == 0 and b.outliers_filtered is False


def test_verification_report(spark, table):
    """S1.14: formatted report; an empty table formats NULL sums without failing."""
    from voxlake.plans.report import as_json_rows, format_report
    text = format_report(table).splitlines()
    assert text[0] == f"size: voxel_count={N} total_points={POINTS} avg_points_per_voxel={POINTS / N:.2f}"
    assert text[3] == "dense cell -4/2/7: n=417 mean=-8.0 std=1.0" and len(text) == 8
    empty = format_report(spark.createDataFrame([], VOXEL_SCHEMA)).splitlines()
    assert empty[0] == "size: voxel_count=0 total_points=None avg_points_per_voxel=None" and len(empty) == 3
    js = [r.json for r in as_json_rows(table.limit(1)).collect()]
    assert js[0].startswith('{"voxel_x":-4')
