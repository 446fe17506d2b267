"""Table reads from stored partial states (S4.4-S4.8, S6.1): equal to a scan after every kind of change."""

import os
import random

import pytest
from conftest import make_points

from voxlake.operators import reads
from voxlake.operators.chunks import Bounds, Grid
from voxlake.plans.build import VoxelConfig, voxelize_points
from voxlake.plans.ingest import ingest, resume
from voxlake.sources.store import VoxelStore

CFG = VoxelConfig(grid_size=3, voxel_size=4.0, filter_outliers=False)


def cloud(spark, seed, n=700):
    rng = random.Random(seed)
    return make_points(spark, *([rng.gauss(0, 15) for _ in range(n)] for _ in range(3)))


def same(store):
    """Every read from states against the same read of the visible rows."""
    rows = store.voxels()
    for stored, scanned in ((store.stats(), reads.voxel_stats(rows)), (store.voxel_summary(), reads.voxel_summary(rows)),
                            (store.extents(), reads.voxel_extents(rows)), (store.elevation_profile(), reads.elevation_profile(rows)),
                            (store.row_count(), reads.row_count(rows))):
        assert stored.columns == scanned.columns and stored.dtypes == scanned.dtypes
        got, want = stored.first().asDict(), scanned.first().asDict()      # an empty table gives NULLs on both sides
        assert [k for k, v in got.items() if v is None] == [k for k, v in want.items() if v is None]
        assert all(v is None or v == pytest.approx(want[k], rel=1e-12) for k, v in got.items())
    for n in (1, 10, 100):
        # Rows of a run and a load may share index and chunk: their order among themselves is open.
        got, want = ([(*r[:4], r.chunk_id) for r in df.collect()] for df in (store.densest(n), reads.densest_voxels(rows, n)))
        assert got == want
    files = [f for df in (store.stats(), store.densest()) for f in df.inputFiles()]
    assert not [f for f in files if f"{os.sep}voxels{os.sep}" in f or f"{os.sep}appended{os.sep}" in f]
    return rows.count()


def test_states_after_each_kind_of_change(spark, tmp_path):
    root = str(tmp_path / "s")
    store = VoxelStore(spark, root)
    pts = cloud(spark, 1)
    b = Bounds.of(pts)
    want = Grid(b, 3).assign(pts).groupBy(Grid(b, 3).chunk_id("chunk").alias("chunk_id")).count().withColumnRenamed("count", "expected_points")
    ingest(spark, pts.where("NOT (x > 0 AND y > 0)"), root, CFG, bounds=b, manifest=want)
    first = same(store)
    assert resume(spark, pts, root, manifest=want).failed == []
    second = same(store)
    store.append_voxels(voxelize_points(cloud(spark, 2), CFG))              # chunk ids of its own grid: the same names
    third = same(store)
    store.append_voxels(voxelize_points(cloud(spark, 3), CFG).drop("chunk_id"))
    fourth = same(store)
    assert first < second < third < fourth
    store.compact()
    assert same(store) == fourth
    store.append_voxels(voxelize_points(cloud(spark, 4), CFG))
    assert same(store) > fourth
    ingest(spark, cloud(spark, 5, 60), root, CFG)
    assert same(store) <= 60
    store.reset()
    assert same(store) == 0


def test_a_load_that_dies_is_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    store = VoxelStore(spark, root)
    ingest(spark, cloud(spark, 1), root, CFG)
    n = same(store)
    more = voxelize_points(cloud(spark, 2), CFG)

    def die(*_, **__):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(reads, "chunk_states", die)
        with pytest.raises(RuntimeError, match="killed"):
            store.append_voxels(more)
    assert same(store) == n
    # A compaction that dies after it copied the loads leaves none to the run that takes its number.
    store.append_voxels(more)
    with monkeypatch.context() as m:
        m.setattr(VoxelStore, "publish", die)
        with pytest.raises(RuntimeError, match="killed"):
            store.compact()
    assert same(store) == n + more.count()
    ingest(spark, cloud(spark, 1), root, CFG)
    assert same(store) == n


def test_runs_without_states_are_read_whole(spark, tmp_path):
    """A run of an earlier version has no states beside it."""
    import shutil
    root = str(tmp_path / "s")
    ingest(spark, cloud(spark, 1), root, CFG)
    shutil.rmtree(os.path.join(root, "states"))
    shutil.rmtree(os.path.join(root, "densest"))
    store = VoxelStore(spark, root)
    assert store.stats().collect() == reads.voxel_stats(store.voxels()).collect()
    assert store.densest(20).collect() == reads.densest_voxels(store.voxels(), 20).collect()


def test_report_from_states(spark, tmp_path):
    from voxlake.plans.report import format_report
    root = str(tmp_path / "s")
    ingest(spark, cloud(spark, 1), root, CFG)
    store = VoxelStore(spark, root)
    assert store.report() == format_report(store.voxels())


def test_densest_rows_of_a_hot_chunk_are_limited_before_the_shuffle(spark):
    v = voxelize_points(cloud(spark, 1), CFG)
    plan = reads.densest_by_chunk(v, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    n = {r.chunk_id: r["count"] for r in reads.densest_by_chunk(v, 3).groupBy("chunk_id").count().collect()}
    assert max(n.values()) == 3


def test_states_of_an_empty_store(spark, tmp_path):
    store = VoxelStore(spark, str(tmp_path / "s")).create()
    assert same(store) == 0
    store.reset()
    assert same(store) == 0
