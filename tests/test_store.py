"""Parquet voxel store: metadata log, append/reset, layout, overwrite and stale partitions."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from voxlake.schemas import FULL, OUTCOME_SCHEMA, RESUME, STORED_VOXEL_SCHEMA, VOXEL_SCHEMA
from voxlake.sources.store import VoxelStore, read_voxel_layout, write_voxel_layout


def test_metadata_set_get_default(spark, store_root):
    """F4 + S1.9: latest value wins; a missing key gives the default."""
    st = VoxelStore(spark, store_root)
    assert st.get_metadata("test_key", "dflt") == "dflt"
    st.set_metadata({"test_key": "test_val", "flag": True, "size": 2.0})
    assert st.get_metadata("test_key") == "test_val"
    assert st.get_metadata("flag") == "True" and st.get_metadata("size") == "2.0"
    st.set_metadata({"test_key": "newer"})
    assert st.get_metadata("test_key") == "newer"
    assert st.get_metadata("missing", "d") == "d"


def test_append_and_reset(spark, store_root):
    """F5 + S1.6/S1.8: bulk append of two rows, reset empties voxels and keeps metadata."""
    st = VoxelStore(spark, store_root)
    rows = [(-4, 7, 31, 9, 62.25, 0.5, 61.5, 63.0), (6, -2, 40, 11, 81.0, 0.75, 80.0, 82.5)]
    st.append_voxels(spark.createDataFrame(rows, VOXEL_SCHEMA))
    st.append_voxels(spark.createDataFrame([], VOXEL_SCHEMA))           # empty -> no-op
    st.set_metadata({"voxel_size": 2.0})
    assert st.voxels().count() == 2
    st.reset()
    assert st.voxels().count() == 0
    assert st.get_metadata("voxel_size") == "2.0"


def test_missing_store_raises(spark, tmp_path):
    """S2.15: a missing table is a clear error."""
    with pytest.raises(FileNotFoundError):
        VoxelStore(spark, str(tmp_path / "nope")).voxels()
    with pytest.raises(FileNotFoundError):
        read_voxel_layout(spark, str(tmp_path / "nope"))


def _vox(spark, chunk, n, base=0):
    rows = [(base + k, k, 0, 1, 1.0, 0.0, 1.0, 1.0, None, chunk) for k in range(n)]
    return spark.createDataFrame(rows, STORED_VOXEL_SCHEMA).drop("run_seq")


def test_layout_partitioned_sorted_and_pruned(spark, tmp_path):
    """S1.4/S1.11: one folder per chunk; rows sorted by index within files; box filters push down."""
    path = str(tmp_path / "vox")
    df = _vox(spark, "0_0", 50).unionByName(_vox(spark, "1_1", 30, 1000))
    write_voxel_layout(df.orderBy(F.rand(1)), path, num_partitions=3)
    assert sorted(d for d in os.listdir(path) if d.startswith("chunk_id=")) == ["chunk_id=0_0", "chunk_id=1_1"]
    back = read_voxel_layout(spark, path)
    assert back.count() == 80
    for chunk in ("0_0", "1_1"):
        for f in os.listdir(os.path.join(path, f"chunk_id={chunk}")):
            if f.endswith(".parquet"):
                xs = pq.read_table(os.path.join(path, f"chunk_id={chunk}", f)).column("voxel_x").to_pylist()
                assert xs == sorted(xs)
    q = back.where((F.col("voxel_x") >= 10) & (F.col("voxel_x") <= 20) & (F.col("chunk_id") == "0_0"))
    plan = plan_text(q)
    assert "GreaterThanOrEqual(voxel_x,10)" in plan and "PartitionFilters" in plan
    assert q.count() == 11


def _out(spark, *rows):
    """Outcome rows ``(chunk_id, voxels, status)``."""
    return spark.createDataFrame([(c, None, n, 0, n, n, st, None) for c, n, st in rows],
                                 ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in OUTCOME_SCHEMA.fields[1:]))


def _publish(spark, st, seq, kind, voxels, *outcomes):
    st.write_voxels(voxels, seq)
    st.write_outcomes(_out(spark, *outcomes), seq)
    st.publish(seq, kind, {"grid_size": 2})


def test_repeated_write_is_idempotent(spark, store_root):
    """S1.12/B3: a run that writes its folder again before publishing leaves its rows once."""
    st = VoxelStore(spark, store_root)
    for _ in range(2):
        st.write_voxels(_vox(spark, "0_0", 3), 1)
    _publish(spark, st, 1, FULL, _vox(spark, "0_0", 3), ("0_0", 3, "ok"))
    assert st.voxels().count() == 3 and st.outcomes().count() == 1


def test_only_published_runs_are_visible(spark, store_root):
    """A chunk shows its latest ok outcome's rows; unpublished folders and replaced runs show nothing."""
    st = VoxelStore(spark, store_root)
    _publish(spark, st, 1, FULL, _vox(spark, "0_0", 3).unionByName(_vox(spark, "0_1", 4)), ("0_0", 3, "ok"), ("0_1", 4, "ok"))
    assert st.voxels().count() == 7
    st.write_voxels(_vox(spark, "0_1", 9), 2)                       # died before its outcomes and publishing
    assert st.voxels().count() == 7 and st.next_run_seq() == 2
    _publish(spark, st, 2, RESUME, _vox(spark, "0_1", 0), ("0_1", 0, "empty"))
    assert st.voxels().count() == 3                                 # run 1's rows of 0_1 are not its latest
    _publish(spark, st, 3, RESUME, _vox(spark, "0_1", 2), ("0_1", 2, "ok"))
    assert st.voxels().count() == 5
    _publish(spark, st, 4, FULL, _vox(spark, "1_0", 6), ("1_0", 6, "ok"))
    assert st.voxels().count() == 6 and [r.chunk_id for r in st.outcomes().collect()] == ["1_0"]


def test_box_lookup_prunes_chunks_and_matches_unpruned(spark, store_root):
    """Store box lookup: chunk partitions outside the box are pruned; rows equal the plain query."""
    from voxlake.operators.reads import voxels_in_box
    from voxlake.plans.build import VoxelConfig
    from voxlake.plans.ingest import ingest
    from voxlake.sources.points import lineitem_points
    pts = lineitem_points(spark, "/root/testdata/sf0.001")
    ingest(spark, pts, store_root, VoxelConfig(grid_size=4, voxel_size=50.0), source="lineitem")
    st = VoxelStore(spark, store_root)
    for kw in (dict(min_x=100.0, max_x=600.0, min_y=0.0, max_y=900.0, max_z=40.0),
               dict(min_x=3, max_x=5, min_y=-1.5, is_voxel_coords=True),
               dict(max_y=250.0)):
        pruned = st.box_voxels(limit=50000, **kw)
        plain = voxels_in_box(st.voxels(), voxel_size=50.0, limit=50000, **kw)
        assert sorted(tuple(r) for r in pruned.collect()) == sorted(tuple(r) for r in plain.collect())
    plan = plan_text(st.box_voxels(min_x=100.0, max_x=600.0))
    assert any("PartitionFilters" in line and "chunk_id" in line for line in plan.splitlines())


@pytest.mark.parametrize("grid", [4, 7, 50])
def test_box_lookup_on_rounded_edges_and_appended_rows(spark, store_root, grid):
    """Bounds 0..460, points on every cell edge: the pruned lookup equals the plain one for boxes that begin
    or end on an edge, and rows appended outside any run show in it."""
    from conftest import make_points
    from voxlake.operators.chunks import Bounds
    from voxlake.operators.reads import voxels_in_box
    from voxlake.plans.build import VoxelConfig
    from voxlake.plans.ingest import ingest
    xs = sorted({k * 460.0 / grid for k in range(grid + 1)} | {float(v) for v in range(0, 461, 20)})
    n = min(len(xs), 24)
    pts = make_points(spark, [x for x in xs for _ in range(n)], [xs[k * (len(xs) - 1) // (n - 1)] for _ in xs for k in range(n)],
                      [1.0] * (len(xs) * n))
    ingest(spark, pts, store_root, VoxelConfig(grid_size=grid, voxel_size=20.0, filter_outliers=False),
           bounds=Bounds(0.0, 460.0, 0.0, 460.0, 1.0, 1.0, len(xs) * n))
    st = VoxelStore(spark, store_root)
    st.append_voxels(spark.createDataFrame([(23, 23, 0, 1, 1.0, 0.0, 1.0, 1.0), (2, 3, 0, 1, 1.0, 0.0, 1.0, 1.0)], VOXEL_SCHEMA))
    for kw in (dict(min_x=460.0), dict(max_x=0.0), dict(min_x=460.0 / grid, max_x=460.0 / grid), dict(min_y=440.0, max_y=460.0),
               dict(min_x=45, max_x=60, min_y=60, max_y=61)):
        pruned = st.box_voxels(limit=50000, **kw).collect()
        plain = voxels_in_box(st.voxels(), voxel_size=20.0, limit=50000, **kw).collect()
        assert sorted(tuple(r) for r in pruned) == sorted(tuple(r) for r in plain) and pruned
    assert any(r.chunk_id == "loaded" for r in st.box_voxels(min_x=460.0).collect())


def test_hot_chunk_split_over_writer_tasks(spark, tmp_path):
    """A chunk holding most voxel rows is written by several tasks (AQE splits the rebalance
    partition above the advisory size), not funnelled into one; rows are all kept."""
    path = str(tmp_path / "vox")
    hot = spark.range(60000).selectExpr("id AS voxel_x", "id % 97 AS voxel_y", "0L AS voxel_z", "1L AS point_count",
                                        "1.0D AS mean_z", "0.0D AS std_z", "1.0D AS min_z", "1.0D AS max_z",
                                        "'0_0' AS chunk_id").repartition(8)
    rest = _vox(spark, "1_1", 50)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write_voxel_layout(hot.unionByName(rest), path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(os.path.join(path, "chunk_id=0_0")) if f.endswith(".parquet")]
    assert len(files) > 1
    assert read_voxel_layout(spark, path).where("chunk_id = '0_0'").count() == 60000


def test_compact_keeps_latest_state(spark, store_root):
    """Compaction publishes one full run with the visible rows, latest outcomes, settings and appended rows."""
    st = VoxelStore(spark, store_root)
    _publish(spark, st, 1, FULL, _vox(spark, "0_0", 3), ("0_0", 3, "ok"), ("0_1", 0, "failed"), ("1_0", 0, "failed"))
    _publish(spark, st, 2, RESUME, _vox(spark, "0_1", 4), ("0_1", 4, "ok"))
    st.append_voxels(spark.createDataFrame([(1, 2, 3, 4, 1.0, 0.0, 1.0, 1.0)], VOXEL_SCHEMA))
    for v in ("a", "b", "c"):
        st.set_metadata({"k": v})

    def state():
        return (st.get_metadata("k"), st.get_metadata("grid_size"), sorted(r.chunk_id for r in st.ledger().collect()),
                sorted(tuple(r) for r in st.voxels().drop("run_seq").collect()), tuple(st.totals().first()))

    before = state()
    st.compact()
    assert state() == before and before[2] == ["1_0"] and len(before[3]) == 8
    assert st.live(st.commits()) == [3] and st.outcomes().count() == 3


def test_create_if_absent(spark, store_root):
    """S1.7: creating an absent store gives empty tables with their schemas; creating again keeps data."""
    st = VoxelStore(spark, store_root)
    assert not st.exists()
    st.create()
    assert st.exists() and st.voxels().count() == 0 and st.metadata().count() == 0
    assert st.voxels().columns == STORED_VOXEL_SCHEMA.fieldNames()
    st.append_voxels(spark.createDataFrame([(1, 2, 3, 4, 1.0, 0.0, 1.0, 1.0)], VOXEL_SCHEMA))
    st.create()
    assert st.voxels().count() == 1


def test_metadata_values_round_trip_exactly(spark, store_root):
    """Metadata is written through SQL literals: awkward strings must come back unchanged."""
    st = VoxelStore(spark, store_root)
    vals = {"json": '["0_1", "1_3"]', "quote": "it's", "backslash": "a\\b\\'c", "newline": "x\ny",
            "unicode": "höhe ≥ 3σ", "empty": "", "float": 0.1, "int": 123456789012, "bool": False}
    st.set_metadata(vals)
    got = {r.key: r.value for r in st.metadata().collect()}
    assert got == {k: ("False" if v is False else str(v)) for k, v in vals.items()}
