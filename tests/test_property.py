"""Property test: the Spark voxel job equals a brute-force computation of the same rules."""

import math

import numpy as np
from hypothesis import HealthCheck, assume, given, settings
from hypothesis import strategies as st

from conftest import make_points
from voxlake.operators.chunks import Bounds, Grid
from voxlake.plans.build import VoxelConfig, chunk_voxels


def brute_force(xs, ys, zs, g, size, filt, lo=-50.0, hi=150.0):
    """Plain loops over the rules: extent from the data, G x G cells (last one closed),
    range filter and 3 sigma (population std) per cell, voxel stats with sample std."""
    x0, x1, y0, y1 = min(xs), max(xs), min(ys), max(ys)
    sx, sy = (x1 - x0) / g, (y1 - y0) / g

    def cell(v, v0, s):
        return 0 if s <= 0 else min(math.floor((v - v0) / s), g - 1)

    cells: dict[str, list] = {}
    for x, y, z in zip(xs, ys, zs):
        cells.setdefault(f"{cell(x, x0, sx)}_{cell(y, y0, sy)}", []).append((x, y, z))
    out = {}
    near_edge = False
    for cid, pts in cells.items():
        if filt:
            pts = [p for p in pts if lo <= p[2] <= hi]
            if len(pts) > 1:
                zz = np.array([p[2] for p in pts])
                m, s = zz.mean(), zz.std()
                if s > 0.01:
                    near_edge |= bool(np.any(np.abs(np.abs(zz - m) - 3 * s) < 1e-9 * max(1.0, abs(m))))
                    pts = [p for p in pts if abs(p[2] - m) <= 3 * s]
        groups: dict[tuple, list] = {}
        for x, y, z in pts:
            groups.setdefault((math.floor(x / size), math.floor(y / size), math.floor(z / size)), []).append(z)
        for key, zl in groups.items():
            a = np.array(zl)
            out[(cid, *key)] = (len(zl), a.mean(), a.std(ddof=1) if len(zl) > 1 else 0.0, a.min(), a.max())
    return out, near_edge


coords = st.floats(min_value=-500, max_value=500, allow_nan=False, allow_infinity=False)
elev = st.one_of(st.floats(min_value=-80, max_value=180, allow_nan=False, allow_infinity=False),
                 st.sampled_from([0.0, 10.0, -50.0, 150.0, 149.99]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pts=st.lists(st.tuples(coords, coords, elev), min_size=1, max_size=60),
       g=st.integers(min_value=1, max_value=4), size=st.sampled_from([0.5, 2.0, 7.5, 50.0]),
       filt=st.booleans())
def test_chunk_voxels_match_brute_force(spark, pts, g, size, filt):
    xs, ys, zs = (list(c) for c in zip(*pts))
    expected, near_edge = brute_force(xs, ys, zs, g, size, filt)
    assume(not near_edge)
    df = make_points(spark, xs, ys, zs)
    grid = Grid(Bounds.of(df), g)
    got = {(r.chunk_id, r.voxel_x, r.voxel_y, r.voxel_z): (r.point_count, r.mean_z, r.std_z, r.min_z, r.max_z)
           for r in chunk_voxels(grid.assign(df), grid, VoxelConfig(grid_size=g, voxel_size=size,
                                                                      filter_outliers=filt)).collect()}
    assert set(got) == set(expected)
    for k, (n, m, s, lo, hi) in expected.items():
        gn, gm, gs, glo, ghi = got[k]
        assert gn == n and glo == lo and ghi == hi
        assert math.isclose(gm, m, rel_tol=1e-9, abs_tol=1e-9) and math.isclose(gs, s, rel_tol=1e-7, abs_tol=1e-9)
