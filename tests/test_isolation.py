"""S11.1: a lost, cut, unreadable or changed file of staged points fails its chunk only, with the reason."""

import math
import os
import random

import pytest
from conftest import make_points
from pyspark.sql import functions as F

from voxlake.operators.chunks import Bounds, Grid
from voxlake.operators.outcomes import chunk_profile, file_profile, merged_profile
from voxlake.plans.build import VoxelConfig
from voxlake.plans.ingest import AllChunksFailed, ingest, resume
from voxlake.session import cut_file
from voxlake.sources.points import write_points
from voxlake.sources.store import VoxelStore

CFG = VoxelConfig(grid_size=3, voxel_size=5.0)


def cloud(spark, seed=6, n=900):
    rng = random.Random(seed)
    xs, ys = [rng.uniform(-20, 70) for _ in range(n)], [rng.uniform(100, 190) for _ in range(n)]
    zs = [rng.gauss(8, 2) if rng.random() > 0.01 else rng.choice([float("nan"), None, -70.0, 400.0, 60.0]) for _ in range(n)]
    return make_points(spark, xs + [None, float("inf")], ys + [1.0, 120.0], zs + [1.0, 2.0])


def voxels(store):
    return sorted(tuple(r) for r in store.voxels().drop("run_seq").collect())


def files_of(staged, chunk):
    folder = os.path.join(staged.path, "points", f"chunk={chunk}")
    return sorted(os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet"))


@pytest.fixture
def staged(spark, tmp_path):
    pts = cloud(spark)
    return write_points(pts, str(tmp_path / "pts"), Grid(Bounds.of(pts), 3))


def test_damaged_files_fail_their_chunks_only_and_resume_recovers(spark, staged, tmp_path):
    whole = str(tmp_path / "whole")
    ingest(spark, staged, whole, CFG)
    again = write_points(cloud(spark), str(tmp_path / "again"), staged.grid)
    cut_file(spark, files_of(staged, 0)[0], 0.0)                        # lost
    cut_file(spark, files_of(staged, 4)[0], 0.6)                        # cut
    with open(files_of(staged, 8)[0], "r+b") as f:                      # overwritten
        f.write(b"x" * 2000)
    root = str(tmp_path / "store")
    res = ingest(spark, staged, root, CFG)
    store = VoxelStore(spark, root)
    assert res.failed == ["0_0", "1_1", "2_2"]
    out = {r.chunk_id: r for r in store.outcomes().collect()}
    assert {k for k, r in out.items() if r.status == "failed"} == set(res.failed) and len(out) == 9
    for k, r in out.items():
        assert r.expected_points > 0
        if k in res.failed:
            assert r.error.startswith("file part-") and r.voxels == r.points_kept == 0
        else:
            assert r.error is None and r.points_read == r.expected_points
    kept = [v for v in voxels(VoxelStore(spark, whole)) if v[-1] not in res.failed]
    assert voxels(store) == kept and kept
    # Only one of them is staged anew: the others stay in the ledger, the store stays readable.
    with pytest.raises(AllChunksFailed):
        resume(spark, staged, root)
    assert voxels(store) == kept
    assert resume(spark, again, root, max_chunks=1).failed == ["1_1", "2_2"]
    assert resume(spark, again, root).failed == []
    assert voxels(store) == voxels(VoxelStore(spark, whole))


def test_other_values_and_foreign_files_are_seen(spark, staged, tmp_path):
    """Same number of rows, other values; and a file that was never staged."""
    path = files_of(staged, 3)[0]
    other = spark.read.parquet(path).selectExpr("x", "y", "z + 1 AS z").toPandas()
    other.to_parquet(path)
    spark.read.parquet(files_of(staged, 5)[0]).toPandas().to_parquet(os.path.join(os.path.dirname(files_of(staged, 5)[0]), "more.parquet"))
    for name in os.listdir(os.path.dirname(path)):
        if name.endswith(".crc"):
            os.truncate(os.path.join(os.path.dirname(path), name), 0)
    root = str(tmp_path / "store")
    res = ingest(spark, staged, root, CFG)
    errors = {r.chunk_id: r.error for r in VoxelStore(spark, root).outcomes().collect() if r.error}
    assert res.failed == sorted(errors) == ["1_0", "1_2"]
    assert "more.parquet was not staged" in errors["1_2"]


def test_a_lost_folder_and_all_lost(spark, staged, tmp_path):
    for f in files_of(staged, 7):
        cut_file(spark, f, 0.0)
    assert ingest(spark, staged, str(tmp_path / "a"), CFG).failed == ["2_1"]
    for k in range(9):
        for f in files_of(staged, k):
            cut_file(spark, f, 0.3)
    with pytest.raises(AllChunksFailed):
        ingest(spark, staged, str(tmp_path / "b"), CFG)
    with pytest.raises(FileNotFoundError):
        VoxelStore(spark, str(tmp_path / "b")).require()


def test_rows_outside_all_chunks_do_not_fail_a_chunk(spark, staged, tmp_path):
    cut_file(spark, files_of(staged, "__HIVE_DEFAULT_PARTITION__")[0], 0.5)
    root = str(tmp_path / "a")
    assert ingest(spark, staged, root, CFG).failed == []
    assert VoxelStore(spark, root).get_metadata("unplaced_fault").startswith("file part-")


def test_the_file_list_is_of_the_staging(spark, staged):
    """Losing a file changes what is read, not what is expected."""
    before = {r.chunk_id: r.expected_points for r in staged.manifest().collect()}
    cut_file(spark, files_of(staged, 2)[0], 0.0)
    assert {r.chunk_id: r.expected_points for r in staged.manifest().collect()} == before
    assert staged.points(tolerant=True).where("chunk = 2").count() < before["0_2"]


def test_other_grids_have_no_file_list(spark, staged, tmp_path):
    """Points staged on another grid are read strictly; their file list names other chunks."""
    res = ingest(spark, staged, str(tmp_path / "a"), CFG.with_(grid_size=2))
    assert res.failed == [] and res.attempted == 4


def test_merged_profiles_equal_the_chunk_profile(spark, staged):
    whole = {r.chunk: r for r in chunk_profile(staged.points()).collect()}
    rows = staged.points(tolerant=True).selectExpr("x", "y", "z", "chunk", "concat(file, pmod(xxhash64(x, y), 3)) AS file")
    merged = {r.chunk: r for r in merged_profile(file_profile(rows)).collect()}
    assert whole.keys() == merged.keys()
    for k, a in whole.items():
        b = merged[k]
        assert (a.points_read, a.points_rejected, a.n_z) == (b.points_read, b.points_rejected, b.n_z)
        for x, y in ((a.mean_z, b.mean_z), (a.std_pop_z, b.std_pop_z)):
            assert (x is None and y is None) or math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12)


def test_a_source_that_changes_while_it_is_staged_raises(spark, tmp_path):
    pts = cloud(spark)
    other = F.udf(lambda z: random.random(), "double").asNondeterministic()
    with pytest.raises(RuntimeError, match="differ from their source"):
        write_points(pts.select("x", "y", other("z").alias("z")), str(tmp_path / "p"), Grid(Bounds.of(pts), 3))
    assert not os.path.exists(tmp_path / "p" / "header")
