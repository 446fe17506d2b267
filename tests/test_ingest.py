"""End-to-end ingest / resume against a store (F8-F10, S11.*, B1, B2) and the run invariants."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.operators.chunks import Bounds
from voxlake.plans.build import VoxelConfig
from voxlake.plans.ingest import ingest, resume, summary
from voxlake.schemas import VOXEL_COLUMNS
from voxlake.sources.store import VoxelStore

# Fixed values of the reference's mocked header: bounds and a 2 x 2 grid of 2.0 m voxels.
HEADER = Bounds(188000.0, 188200.0, 1878900.0, 1879100.0, 0.0, 50.0, 40)
CFG = VoxelConfig(grid_size=2, voxel_size=2.0)


def _points(spark, per_chunk=10, seed=3, grid=2):
    """Seeded points inside each chunk box (FIXTURES: ours are placed per box, ids kept)."""
    rng = np.random.RandomState(seed)
    rows, pid = [], 0
    sx = (HEADER.max_x - HEADER.min_x) / grid
    sy = (HEADER.max_y - HEADER.min_y) / grid
    for i in range(grid):
        for j in range(grid):
            for _ in range(per_chunk):
                x = HEADER.min_x + (i + rng.uniform(0.01, 0.99)) * sx
                y = HEADER.min_y + (j + rng.uniform(0.01, 0.99)) * sy
                rows.append((pid, float(x), float(y), float(rng.normal(11.0, 0.5))))
                pid += 1
    return spark.createDataFrame(rows, "pid long, x double, y double, z double")


def _manifest(spark, pts, grid_size=2):
    from voxlake.operators.chunks import Grid
    g = Grid(HEADER, grid_size)
    return g.assign(pts).groupBy(g.chunk_id("chunk").alias("chunk_id")).agg(F.count("*").alias("expected_points"))


def _lose(pts, box, every=2):
    """Drop every other row inside a box: a partial read of that chunk."""
    x0, x1, y0, y1 = box
    inside = (F.col("x") >= x0) & (F.col("x") < x1) & (F.col("y") >= y0) & (F.col("y") < y1)
    return pts.where(~inside | (F.col("pid") % every != 0))


BOX_0_1 = (188000.0, 188100.0, 1879000.0, 1879100.0)
BOX_1_0 = (188100.0, 188200.0, 1878900.0, 1879000.0)
BOX_1_1 = (188100.0, 188200.0, 1879000.0, 1879100.0)


def _rows(df):
    return sorted(tuple(r) for r in df.select("chunk_id", *VOXEL_COLUMNS).collect())


def test_full_run(spark, store_root):
    """F8: all chunks load; metadata recorded as text; no failures."""
    pts = _points(spark)
    res = ingest(spark, pts, store_root, CFG, source="test://points", bounds=HEADER)
    assert res.status == "success" and res.failed == [] and res.attempted == 4
    assert res.stats["total_voxels"] > 0 and res.stats["total_points"] == 40
    st = VoxelStore(spark, store_root)
    assert st.get_metadata("grid_size") == "2" and st.get_metadata("voxel_size") == "2.0"
    assert st.get_metadata("failed_chunks") == "[]" and st.get_metadata("filter_outliers") == "True"
    outs = {r.chunk_id: r.status for r in st.outcomes().collect()}
    assert {r.error for r in st.outcomes().collect()} == {None}
    assert outs == {"0_0": "ok", "0_1": "ok", "1_0": "ok", "1_1": "ok"}
    s = summary(spark, store_root).first()
    assert s.grid_size == 2 and s.voxel_size_meters == 2.0 and s.source == "test://points"


def test_one_chunk_fails(spark, store_root):
    """chunk 0_1 reads short of its manifest -> skipped, listed in the ledger; others load."""
    full = _points(spark)
    res = ingest(spark, _lose(full, BOX_0_1), store_root, CFG, bounds=HEADER, manifest=_manifest(spark, full))
    assert res.status == "success" and res.failed == ["0_1"]
    st = VoxelStore(spark, store_root)
    assert json.loads(st.get_metadata("failed_chunks")) == ["0_1"]
    loaded = {r.chunk_id for r in st.voxels().select("chunk_id").distinct().collect()}
    assert loaded == {"0_0", "1_0", "1_1"}
    assert {r.chunk_id: r.error for r in st.outcomes().collect() if r.error} == {"0_1": "read 5 of 10 rows"}


def test_resume_recovers_and_equals_full_run(spark, tmp_path):
    """F10 + S7.1: resume handles only 0_1, appends, clears the ledger; partial + resume = full."""
    full = _points(spark)
    man = _manifest(spark, full)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    ingest(spark, _lose(full, BOX_0_1), a, CFG, bounds=HEADER, manifest=man)
    st = VoxelStore(spark, a)
    seed = spark.createDataFrame([(-8, 15, 22, 64, 45.0, 1.5, 43.0, 47.0)], ", ".join(
        f"{c} {'bigint' if i < 4 else 'double'}" for i, c in enumerate(VOXEL_COLUMNS)))
    before = st.voxels().count()
    res = resume(spark, full, a, manifest=man)
    assert res.status == "success" and res.attempted == 1 and res.failed == []
    assert st.voxels().count() > before
    assert {r.chunk_id: r.status for r in st.ledger().collect()} == {}
    ingest(spark, full, b, CFG, bounds=HEADER)
    assert _rows(VoxelStore(spark, a).voxels()) == _rows(VoxelStore(spark, b).voxels())
    # the reference's seeded-row variant: a row loaded outside any run stays and is counted
    st.append_voxels(seed, "seed")
    s = summary(spark, a).first()
    assert s.total_points > 50 and s.failed_chunk_count == 0


def test_resume_nothing_to_do(spark, store_root):
    """S11.4: empty ledger -> skipped, tables untouched."""
    pts = _points(spark)
    ingest(spark, pts, store_root, CFG, bounds=HEADER)
    n = VoxelStore(spark, store_root).voxels().count()
    assert resume(spark, pts, store_root).status == "skipped"
    assert VoxelStore(spark, store_root).voxels().count() == n


def test_resume_with_limit_keeps_unattempted(spark, store_root):
    """B1: resume of the first N failed chunks removes only those from the ledger."""
    full = _points(spark)
    man = _manifest(spark, full)
    lossy = _lose(_lose(_lose(full, BOX_0_1), BOX_1_0), BOX_1_1)
    res = ingest(spark, lossy, store_root, CFG, bounds=HEADER, manifest=man)
    assert res.failed == ["0_1", "1_0", "1_1"]
    again = resume(spark, _lose(full, BOX_1_0), store_root, manifest=man, max_chunks=2)
    assert again.attempted == 2
    assert again.failed == ["1_0", "1_1"]          # 1_0 failed again, 1_1 not attempted
    st = VoxelStore(spark, store_root)
    assert sorted(r.chunk_id for r in st.ledger().collect()) == again.failed      # ledger as data agrees
    assert json.loads(st.get_metadata("failed_chunks")) == again.failed
    last = resume(spark, full, store_root, manifest=man)
    assert last.failed == [] and last.attempted == 2


def test_resume_refuses_other_settings(spark, store_root):
    """B2: a resume whose grid/voxel settings or source differ from the stored run is refused."""
    full = _points(spark)
    ingest(spark, _lose(full, BOX_0_1), store_root, CFG, source="src", bounds=HEADER,
           manifest=_manifest(spark, full))
    with pytest.raises(ValueError):
        resume(spark, full, store_root, cfg=CFG.with_(voxel_size=5.0))
    with pytest.raises(ValueError):
        resume(spark, full, store_root, source="other")


def test_all_chunks_failed_is_an_error(spark, store_root):
    """S11.2: every attempted chunk failed -> error, nothing loaded."""
    full = _points(spark)
    man = _manifest(spark, full).withColumn("expected_points", F.col("expected_points") + 1)
    with pytest.raises(RuntimeError):
        ingest(spark, full, store_root, CFG, bounds=HEADER, manifest=man)


def test_max_chunks_full_run(spark, store_root):
    """S2.11: a full run limited to the first N chunks in grid order."""
    res = ingest(spark, _points(spark), store_root, CFG.with_(max_chunks=3), bounds=HEADER)
    assert res.attempted == 3
    got = {r.chunk_id for r in VoxelStore(spark, store_root).voxels().select("chunk_id").distinct().collect()}
    assert got == {"0_0", "0_1", "1_0"}


def test_rejected_rows_counted_not_failed(spark, store_root):
    """NaN/NULL rows are counted per chunk and dataset-wide, and do not fail a chunk."""
    pts = _points(spark)
    bad = spark.createDataFrame([(900, 188010.0, 1878910.0, float("nan")), (901, float("nan"), 1878910.0, 1.0),
                                 (902, 188010.0, 1878910.0, None)], "pid long, x double, y double, z double")
    both = pts.unionByName(bad)
    res = ingest(spark, both, store_root, CFG, bounds=HEADER, manifest=_manifest(spark, both))
    assert res.failed == []
    st = VoxelStore(spark, store_root)
    o = {r.chunk_id: r for r in st.outcomes().collect()}
    assert o["0_0"].points_rejected == 2 and o["0_0"].status == "ok"
    assert st.get_metadata("points_unplaced") == "1"


def test_shuffle_partitions_do_not_change_rows(spark, store_root):
    """Invariant: results do not depend on the number of shuffle partitions (within 1e-9)."""
    from voxlake.plans.build import voxelize_points
    from voxlake.sources.points import events_points
    pts = events_points(spark, "/root/testdata/sf0.001")
    cfg = VoxelConfig(grid_size=4, voxel_size=20.0)
    b = Bounds.of(pts)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = sorted(tuple(r) for r in voxelize_points(pts, cfg, b).collect())
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        many = sorted(tuple(r) for r in voxelize_points(pts, cfg, b).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(one) == len(many)
    for r1, r2 in zip(one, many):
        assert r1[:4] == r2[:4] and r1[-1] == r2[-1]
        assert all(abs(u - v) <= 1e-9 * max(1.0, abs(u)) for u, v in zip(r1[4:8], r2[4:8]))


def test_zero_chunk_run_is_skipped_and_leaves_store(spark, store_root):
    """S11.4: a run that attempts no chunk (limit 0) is skipped and does not reset the table."""
    ingest(spark, _points(spark), store_root, CFG, bounds=HEADER)
    n = VoxelStore(spark, store_root).voxels().count()
    res = ingest(spark, _points(spark), store_root, CFG.with_(max_chunks=0), bounds=HEADER)
    assert res.status == "skipped" and res.attempted == 0
    assert VoxelStore(spark, store_root).voxels().count() == n > 0


def test_empty_source_gives_empty_table(spark, store_root):
    """S11.2 design: no points at all -> every chunk 'empty', an empty voxel table, no error."""
    empty = spark.createDataFrame([], "pid long, x double, y double, z double")
    res = ingest(spark, empty, store_root, CFG)
    assert res.status == "success" and res.failed == [] and res.stats["total_voxels"] == 0
    st = VoxelStore(spark, store_root)
    assert {r.status for r in st.outcomes().collect()} == {"empty"}
    assert st.voxels().count() == 0 and st.voxels().columns[-1] == "chunk_id"


def test_store_endpoints(spark, store_root):
    """The reference's stats / densest / box / verify calls map to store methods."""
    ingest(spark, _points(spark, per_chunk=30), store_root, CFG, source="src", bounds=HEADER)
    st = VoxelStore(spark, store_root)
    s = st.summary().first()
    assert s.total_points == 120 and s.grid_size == 2 and s.source == "src" and s.failed_chunk_count == 0
    top = st.densest(3).collect()
    assert len(top) == 3 and top[0].point_count >= top[-1].point_count
    box = st.box_voxels(min_x=188000.0, max_x=188099.0).collect()
    assert box and all(r.voxel_x <= 94049 for r in box)
    assert "total_points=120" in st.report()
    assert st.totals().first().total_points_read == 120


@pytest.mark.parametrize("seed", [5, 17])
def test_resume_until_clean_equals_full_run(spark, tmp_path, seed):
    """Invariant: any pattern of failed chunks and limited resumes ends in the full run's table."""
    rng = np.random.RandomState(seed)
    full = _points(spark, per_chunk=12, seed=seed, grid=3)
    g3 = VoxelConfig(grid_size=3, voxel_size=2.0)
    from voxlake.operators.chunks import Grid
    grid = Grid(HEADER, 3)
    man = grid.assign(full).groupBy(grid.chunk_id("chunk").alias("chunk_id")).agg(F.count("*").alias("expected_points"))

    def lossy(chunks):
        out = full
        for cid in chunks:
            out = grid.assign(out).where(f"chunk <> {grid.ordinal(cid)} OR pid % 2 <> 0").drop("chunk")
        return out

    ids = [f"{i}_{j}" for i in range(3) for j in range(3)]
    failing = list(rng.choice(ids, size=4, replace=False))
    a = str(tmp_path / "a")
    res = ingest(spark, lossy(failing), a, g3, bounds=HEADER, manifest=man)
    assert res.failed == sorted(failing)
    ledger, rounds = res.failed, 0
    while ledger:
        again = [c for c in ledger if rng.rand() < 0.3][:1]                # some chunks fail once more
        limit = int(rng.randint(1, 3))
        try:
            ledger = resume(spark, lossy(again), a, manifest=man, max_chunks=limit).failed
        except RuntimeError:
            # S11.2: every attempted chunk failed again -> the run aborts and changes nothing
            assert set(sorted(ledger)[:limit]) <= set(again)
            assert sorted(r.chunk_id for r in VoxelStore(spark, a).ledger().collect()) == ledger
        rounds += 1
        assert rounds < 12
    b = str(tmp_path / "b")
    ingest(spark, full, b, g3, bounds=HEADER)
    assert _rows(VoxelStore(spark, a).voxels()) == _rows(VoxelStore(spark, b).voxels())


@pytest.mark.parametrize("grid", [7, 50])
def test_resume_on_rounded_edges_loses_no_point(spark, tmp_path, grid):
    """x, y on every cell edge of 0..460: resume of any failed chunk, with and without staging, equals the full run."""
    from conftest import make_points
    from voxlake.operators.chunks import Grid
    from voxlake.sources.points import write_points
    xs = sorted({k * 460.0 / grid for k in range(grid + 1)} | {k * (460.0 / grid) for k in range(grid)} | {float(v) for v in range(0, 461, 20)})
    xs = xs[:: max(1, len(xs) // 24)] + [460.0]
    pts = make_points(spark, [x for x in xs for _ in xs], [y for _ in xs for y in xs], [1.0] * len(xs) ** 2)
    b = Bounds(0.0, 460.0, 0.0, 460.0, 1.0, 1.0, len(xs) ** 2)
    g = Grid(b, grid)
    man = g.assign(pts).groupBy(g.chunk_id("chunk").alias("chunk_id")).agg(F.count("*").alias("expected_points"))
    cfg = VoxelConfig(grid_size=grid, voxel_size=20.0, filter_outliers=False)
    bad = {0, grid * grid - 1, grid + 1}
    lossy = g.assign(pts).where(f"NOT (chunk IN ({', '.join(map(str, bad))}) AND x + y > 0 AND x = int(x))").drop("chunk")
    want = None
    for name, again in (("plain", pts), ("staged", write_points(pts, str(tmp_path / "pts"), g))):
        root = str(tmp_path / name)
        first = ingest(spark, lossy, root, cfg, bounds=b, manifest=man)
        assert first.failed
        res = resume(spark, again, root, manifest=man)
        assert res.failed == [] and res.stats["total_points"] == len(xs) ** 2
        rows = _rows(VoxelStore(spark, root).voxels())
        want = want or rows
        assert rows == want


def test_a_killed_run_leaves_the_previous_one_whole(spark, store_root, monkeypatch):
    """A second full run that dies at any of its writes shows nothing: rows, outcomes and settings stay."""
    pts = _points(spark)
    ingest(spark, pts, store_root, CFG, source="one", bounds=HEADER)
    st = VoxelStore(spark, store_root)
    before = (_rows(st.voxels()), sorted(map(tuple, st.outcomes().collect())), sorted(map(tuple, st.metadata().collect())))
    for name in ("write_voxels", "write_outcomes", "publish"):
        with monkeypatch.context() as m:
            real = getattr(VoxelStore, name)

            def dying(self, *a, _real=real, _name=name, **kw):
                if _name != "publish":
                    _real(self, *a, **kw)
                raise KeyboardInterrupt(_name)

            m.setattr(VoxelStore, name, dying)
            with pytest.raises(KeyboardInterrupt):
                ingest(spark, pts, store_root, CFG.with_(voxel_size=5.0), source="two", bounds=HEADER)
        now = (_rows(st.voxels()), sorted(map(tuple, st.outcomes().collect())), sorted(map(tuple, st.metadata().collect())))
        assert now == before
    ingest(spark, pts, store_root, CFG.with_(voxel_size=5.0), source="two", bounds=HEADER)
    assert st.get_metadata("source") == "two" and st.get_metadata("voxel_size") == "5.0" and _rows(st.voxels()) != before[0]


def test_share_floor_fails_chunks_with_a_reason(spark, store_root):
    """Chunks whose in-range share lies below the floor times the whole read's are left out; a resume with no
    floor takes them in."""
    pts = _points(spark)
    high = pts.where("pid % 2 = 0 AND x < 188100 AND y < 1879000").selectExpr("pid + 1000 AS pid", "x", "y", "999D AS z")
    both = pts.unionByName(high)
    res = ingest(spark, both, store_root, CFG.with_(share_floor=0.9), bounds=HEADER)
    st = VoxelStore(spark, store_root)
    assert res.failed == ["0_0"]
    assert {r.chunk_id: r.error for r in st.outcomes().collect() if r.error} == {"0_0": "in-range share below the floor"}
    assert resume(spark, both, store_root).failed == []
    assert st.totals().first().chunks_failed == 0 and st.voxels().agg(F.sum("point_count")).first()[0] == 40


def test_no_single_task_aggregate_and_no_rdd():
    """Nothing merges an aggregate in one task, and no plan is opened as an RDD."""
    import pathlib
    import re
    root = pathlib.Path(__file__).resolve().parents[1] / "voxlake"
    text = {p: p.read_text() for p in root.rglob("*.py") if "llm" not in p.parts}
    assert not [p for p, s in text.items() if ".rdd" in s or "localCheckpoint" in s]
    for p, s in text.items():       # one-row literal frames only
        assert all("values_frame" in s[max(0, m.start() - 250):m.start()] or "range(1)" in s[max(0, m.start() - 400):m.start()]
                   for m in re.finditer(r"coalesce\(1\)", s)), p
