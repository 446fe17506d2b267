"""S6.3 on a stored table: the first grid columns are read, as far as the limit needs them."""

import pytest

from voxlake.operators.chunks import Bounds, Grid
from voxlake.operators.reads import voxels_in_box
from voxlake.plans.build import VoxelConfig
from voxlake.plans.ingest import ingest, resume
from voxlake.schemas import VOXEL_COLUMNS
from voxlake.sources import store as S
from voxlake.sources.store import VoxelStore

SIDE, GRID = 40, 8


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A square of SIDE x SIDE columns of three voxels, some of which straddle a chunk edge."""
    root = str(tmp_path_factory.mktemp("topk") / "store")
    pts = spark.range(SIDE * SIDE * 3).selectExpr(f"CAST(id % {SIDE} AS DOUBLE) AS x", f"CAST(id DIV {SIDE} % {SIDE} AS DOUBLE) AS y",
                                                  f"CAST(id DIV {SIDE * SIDE} AS DOUBLE) * 2 AS z")
    ingest(spark, pts, root, VoxelConfig(grid_size=GRID, voxel_size=2.0, filter_outliers=False))
    return VoxelStore(spark, root)


def looked_at(store, monkeypatch):
    """Predicates on the rows of the runs that box lookups end with."""
    seen, real = [], store._visible

    def visible(commits, rows):
        seen.append(rows.select("chunk_id").distinct().count())
        return real(commits, rows)
    monkeypatch.setattr(store, "_visible", visible)
    return seen


BOXES = [{}, {"min_y": 10, "max_y": 10}, {"min_x": 3, "max_z": 0}, {"min_z": 1, "max_z": 1, "min_y": 4}, {"min_x": 500}, {"max_x": -1}]


@pytest.mark.parametrize("box", BOXES)
@pytest.mark.parametrize("limit", [1, 7, 60, 5000])
def test_equal_to_the_full_sort(stored, monkeypatch, box, limit):
    monkeypatch.setattr(S, "STEP_ROWS", 1)
    got = stored.box_voxels(**box, is_voxel_coords=True, limit=limit).collect()
    want = voxels_in_box(stored.voxels(), **box, is_voxel_coords=True, limit=limit).collect()
    assert got == want


def test_later_columns_are_not_read(stored, monkeypatch):
    chunks = GRID * GRID
    for step, fewer in ((1, True), (1 << 20, False)):
        with monkeypatch.context() as m:
            m.setattr(S, "STEP_ROWS", step)
            seen = looked_at(stored, m)
            assert stored.box_voxels(min_y=0, is_voxel_coords=True, limit=20).count() == 20
            assert (seen[-1] <= chunks // 4) == fewer and (len(seen) > 1) == fewer
    with monkeypatch.context() as m:        # too few rows anywhere: the columns double until all are read
        m.setattr(S, "STEP_ROWS", 1)
        seen = looked_at(stored, m)
        assert stored.box_voxels(min_y=10, max_y=10, min_z=1, max_z=1, is_voxel_coords=True, limit=50000).count() > 0
        assert len(seen) <= 5


def test_loads_and_resumed_chunks_count(spark, tmp_path, monkeypatch):
    """Rows loaded on top come before, and a resume brings back chunks of the first column."""
    monkeypatch.setattr(S, "STEP_ROWS", 1)
    root = str(tmp_path / "store")
    pts = spark.range(1600).selectExpr("CAST(id % 40 AS DOUBLE) AS x", "CAST(id DIV 40 AS DOUBLE) AS y", "CAST(id % 3 AS DOUBLE) AS z")
    cfg = VoxelConfig(grid_size=4, voxel_size=1.0, filter_outliers=False)
    grid = Grid(Bounds.of(pts), cfg.grid_size)      # a chunk that the manifest does not name is expected to be empty
    manifest = (grid.assign(pts).groupBy(grid.chunk_id().alias("chunk_id")).count()
                .selectExpr("chunk_id", "if(chunk_id IN ('0_0', '0_2'), 7, count) AS expected_points"))
    assert ingest(spark, pts, root, cfg, manifest=manifest).failed == ["0_0", "0_2"]
    store = VoxelStore(spark, root)

    def same():
        for box, limit in (({}, 12), ({"min_y": 1, "max_y": 3}, 5), ({"min_x": 2}, 40)):
            got = store.box_voxels(**box, is_voxel_coords=True, limit=limit).collect()
            assert got == voxels_in_box(store.voxels(), **box, is_voxel_coords=True, limit=limit).collect()
        return got
    before = same()
    rows = store.voxels().where("voxel_x = 39").selectExpr("voxel_x - 37 AS voxel_x", *VOXEL_COLUMNS[1:])
    store.append_voxels(rows)
    loaded = same()
    assert loaded != before and any(r.chunk_id == "loaded" for r in loaded)
    assert resume(spark, pts, root).failed == []
    assert same() != loaded


def test_bad_limits_are_refused_before_any_read(stored):
    for limit in (0, -1, 50001):
        with pytest.raises(ValueError):
            stored.box_voxels(limit=limit)
