"""Registered queries over the given test tables, one callable per key.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the *whole*
tables. Float aggregates whose last bits depend on merge order (means, stds) are shown
with :func:`voxlake.functions.quantize`, the same arithmetic the oracle SQL applies.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.functions import quantize
from voxlake.operators.chunks import Bounds, Grid, chunk_occupancy, points_bounds
from voxlake.operators.clean import chunk_z_stats, clean_points, elevation_filter, in_range
from voxlake.operators.reads import (densest_report, densest_voxels, elevation_profile, row_count,
                                     run_summary, voxel_extents, voxel_stats, voxel_summary,
                                     voxels_between, voxels_in_box)
from voxlake.operators.voxels import voxel_index
from voxlake.plans.build import VoxelConfig, usable_points, voxelize_points
from voxlake.plans.ingest import AllChunksFailed, ingest, resume
from voxlake.schemas import VOXEL_COLUMNS
from voxlake.session import cut_file, scratch_path
from voxlake.sources import points as P
from voxlake.sources.store import VoxelStore, read_voxel_layout, write_voxel_layout
from voxlake.sources.values import values_frame


@dataclass(frozen=True)
class PointView:
    """A point projection of one test table with the run options used on it."""

    table: str
    grid: int
    voxel_size: float
    filter_outliers: bool = True
    z_min: float = -50.0
    z_max: float = 150.0
    narrow: tuple = (-40.0, 100.0)
    first_chunks: int = 3
    box: dict | None = None
    index_box: dict | None = None
    between: tuple = (10, 20, 10, 20)
    box_limit: int = 1000
    resume_max_chunks: int = 2
    metadata: tuple = ()

    def points(self, spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
        reader = {"lineitem": P.lineitem_points, "events": P.events_points,
                  "embeddings": P.embedding_points}[self.table]
        return reader(spark, sf_dir, keep)

    def config(self, **kw) -> VoxelConfig:
        return VoxelConfig(grid_size=self.grid, voxel_size=self.voxel_size,
                           filter_outliers=self.filter_outliers, z_min=self.z_min, z_max=self.z_max).with_(**kw)


LINEITEM = PointView(
    "lineitem", grid=8, voxel_size=50.0,
    box=dict(min_x=230.0, max_x=1020.5, min_y=-10.0, max_y=1500.0, max_z=60.0),
    index_box=dict(min_x=-1.5, max_x=12.9, min_y=5.2, max_y=20.7, min_z=-1.5),
    metadata=(("voxel_size", "2.0", 0), ("voxel_size", "50.0", 1), ("grid_size", "8", 1),
              ("source", "lineitem", 1), ("filter_outliers", "True", 1), ("failed_chunks", "[]", 1)),
)
EVENTS = PointView("events", grid=4, voxel_size=20.0)
EMBED = PointView("embeddings", grid=4, voxel_size=10.0, filter_outliers=False)

# Chunks fail where their in-range share lies below this part of the table's; a resume asks for less.
SHARE_FLOOR, RESUME_FLOOR = 0.995, 0.99


def q_voxels(vox: DataFrame) -> DataFrame:
    """Voxel rows for comparison: mean/std quantized, other columns exact."""
    cols = (["chunk_id"] if "chunk_id" in vox.columns else []) + VOXEL_COLUMNS
    return vox.select(*[quantize(c).alias(c) if c in ("mean_z", "std_z") else c for c in cols])


def _grid(view: PointView, pts: DataFrame) -> Grid:
    return Grid(Bounds.of(pts), view.grid)


def _p1_voxels(spark: SparkSession, d: str) -> DataFrame:
    return voxelize_points(LINEITEM.points(spark, d), LINEITEM.config())


# -- stored runs: the product's ingest and resume into a fresh store under the checkpoint root -------

def _ingested(spark: SparkSession, d: str, view: PointView, cfg: VoxelConfig | None = None) -> tuple[str, VoxelStore]:
    root = scratch_path(spark, f"store-{view.table}")
    ingest(spark, view.points(spark, d), root, cfg or view.config(), source=view.table)
    return root, VoxelStore(spark, root)


def _resumed(spark: SparkSession, d: str, floor: float | None, max_chunks: int | None = None) -> VoxelStore:
    """Events under a share floor, then a resume of the failed chunks under a lower one."""
    root, store = _ingested(spark, d, EVENTS, EVENTS.config(share_floor=SHARE_FLOOR))
    try:
        resume(spark, EVENTS.points(spark, d), root, cfg=EVENTS.config(share_floor=floor), max_chunks=max_chunks)
    except AllChunksFailed:     # the run publishes nothing (S11.2)
        pass
    return store


OUTCOME_COLS = ["chunk_id", "expected_points", "points_read", "points_rejected", "points_kept", "voxels", "status", "error"]


# -- the registered queries -------------------------------------------------------------------

def points_bounds_q(spark, d):
    return points_bounds(LINEITEM.points(spark, d))


def points_in_box_q(spark, d):
    """Over the staged layout: chunk folders outside the box are pruned, x and y ranges reach the scan."""
    pts = EVENTS.points(spark, d)
    staged = P.write_points(pts, scratch_path(spark, "staged-events"), _grid(EVENTS, pts))
    return staged.in_box(30.0, 90.0, 100.0, 500.0)


def chunk_occupancy_q(spark, d):
    pts = LINEITEM.points(spark, d)
    return chunk_occupancy(pts, _grid(LINEITEM, pts))


def elevation_filter_q(spark, d):
    pts = EVENTS.points(spark, d)
    grid = _grid(EVENTS, pts)
    use = usable_points(grid.assign(pts))
    return (use.groupBy("chunk")
            .agg(F.count(F.lit(1)).alias("n_points"),
                 F.count(F.when(in_range(EVENTS.z_min, EVENTS.z_max), 1)).alias("n_in_range"))
            .select(grid.chunk_id("chunk").alias("chunk_id"), "n_points", "n_in_range"))


def chunk_z_stats_q(spark, d):
    pts = EVENTS.points(spark, d)
    grid = _grid(EVENTS, pts)
    st = chunk_z_stats(elevation_filter(usable_points(grid.assign(pts)), EVENTS.z_min, EVENTS.z_max))
    return st.select(grid.chunk_id("chunk").alias("chunk_id"), "n_z",
                     quantize("mean_z").alias("mean_z"), quantize("std_pop_z").alias("std_pop_z"))


def sigma_filter_q(spark, d):
    pts = EVENTS.points(spark, d)
    grid = _grid(EVENTS, pts)
    kept = clean_points(usable_points(grid.assign(pts)), True, EVENTS.z_min, EVENTS.z_max,
                        chunk_bound=grid.n_chunks)
    return (kept.groupBy("chunk").agg(F.count(F.lit(1)).alias("n_kept"))
            .select(grid.chunk_id("chunk").alias("chunk_id"), "n_kept"))


def voxel_index_q(spark, d):
    pts = EMBED.points(spark, d, keep=["vec_id"])
    return voxel_index(pts, EMBED.voxel_size)


def voxelize_raw_q(spark, d):
    return q_voxels(voxelize_points(EMBED.points(spark, d), EMBED.config()))


def voxelize_clean_q(spark, d):
    return q_voxels(_p1_voxels(spark, d))


def voxelize_events_q(spark, d):
    pts = EVENTS.points(spark, d)
    b = Bounds.of(pts)
    lo, hi = EVENTS.narrow
    dflt = voxelize_points(pts, EVENTS.config(), b)
    narrow = voxelize_points(pts, EVENTS.config(z_min=lo, z_max=hi), b)
    return (q_voxels(dflt).select(F.lit("default").alias("z_limits"), "*")
            .unionByName(q_voxels(narrow).select(F.lit("narrow").alias("z_limits"), "*")))


def voxelize_first_chunks_q(spark, d):
    cfg = LINEITEM.config(max_chunks=LINEITEM.first_chunks)
    return q_voxels(voxelize_points(LINEITEM.points(spark, d), cfg))


def chunk_outcomes_q(spark, d):
    return _ingested(spark, d, EVENTS, EVENTS.config(share_floor=SHARE_FLOOR))[1].outcomes().select(*OUTCOME_COLS)


def ingest_totals_q(spark, d):
    return _ingested(spark, d, LINEITEM)[1].totals()


def stored_totals_q(spark, d):
    """S4.9 of a store with failed chunks and a resume."""
    return _resumed(spark, d, RESUME_FLOOR).totals()


def ingest_store_q(spark, d):
    return q_voxels(_ingested(spark, d, LINEITEM)[1].voxels())


def ingest_twice_q(spark, d):
    """A second full run with other settings replaces the first; compaction changes nothing."""
    root, store = _ingested(spark, d, EVENTS)
    ingest(spark, EVENTS.points(spark, d), root, EVENTS.config().with_(voxel_size=2 * EVENTS.voxel_size), source="events")
    store.compact()
    return q_voxels(store.voxels())


def stored_append_q(spark, d):
    """S1.6: rows appended outside any run show in box lookups next to the run's own."""
    _, store = _ingested(spark, d, LINEITEM)
    store.append_voxels(voxelize_points(EVENTS.points(spark, d), EVENTS.config()).drop("chunk_id"))
    return q_voxels(store.box_voxels(limit=LINEITEM.box_limit, **LINEITEM.box))


def stored_box_lookup_q(spark, d):
    return q_voxels(_ingested(spark, d, LINEITEM)[1].box_voxels(limit=LINEITEM.box_limit, **LINEITEM.box))


def staged_ingest_q(spark, d):
    """Stage the points by chunk, then ingest from the folders, checked against their manifest."""
    pts = EVENTS.points(spark, d)
    staged = P.write_points(pts, scratch_path(spark, "staged-events"), _grid(EVENTS, pts))
    root = scratch_path(spark, "store-staged")
    ingest(spark, staged, root, EVENTS.config(), source="events")
    return q_voxels(VoxelStore(spark, root).voxels())


def _damaged(spark, d) -> P.StagedPoints:
    """Events staged by chunk; after that a file of the second occupied chunk is lost and one of the third is cut in half."""
    pts = EVENTS.points(spark, d)
    staged = P.write_points(pts, scratch_path(spark, "staged-events"), _grid(EVENTS, pts))
    files = staged.files().where("chunk IS NOT NULL").groupBy("chunk").agg(F.min("file").alias("file")).orderBy("chunk").limit(3).collect()
    for r, share in zip(files[1:], (0.0, 0.5)):
        cut_file(spark, os.path.join(staged.path, "points", f"chunk={r['chunk']}", r["file"]), share)
    return staged


def staged_damage_q(spark, d):
    """S11.1: exactly the chunks of the lost and of the cut file fail, the others load."""
    root = scratch_path(spark, "store-damaged")
    ingest(spark, _damaged(spark, d), root, EVENTS.config(), source="events")
    return VoxelStore(spark, root).outcomes().select("chunk_id", "expected_points", "points_kept", "voxels", "status")


def staged_repair_q(spark, d):
    """S11.3: a resume from points staged anew recovers the chunks of the damaged files."""
    root = scratch_path(spark, "store-repaired")
    ingest(spark, _damaged(spark, d), root, EVENTS.config(), source="events")
    pts = EVENTS.points(spark, d)
    resume(spark, P.write_points(pts, scratch_path(spark, "staged-again"), _grid(EVENTS, pts)), root)
    return q_voxels(VoxelStore(spark, root).voxels())


def _stored(spark, d) -> VoxelStore:
    """Events with failed chunks, a resume that recovers some, and the voxels of another table loaded on top."""
    store = _resumed(spark, d, RESUME_FLOOR)
    store.append_voxels(voxelize_points(EMBED.points(spark, d), EMBED.config()).drop("chunk_id"))
    return store


def stored_reads_q(spark, d):
    """S4.4-S4.8 of a stored table from its partial states, one row."""
    store = _stored(spark, d)
    mean = store.voxel_summary().select(quantize("avg_points_per_voxel").alias("avg_points_per_voxel"))
    height = store.elevation_profile().select("min_elev", "max_elev", quantize("avg_elev").alias("avg_elev"))
    # One row each; the extents (S4.6) and the count (S4.8) hold the values of the stats under other names.
    return store.stats().crossJoin(mean).crossJoin(height)


def stored_densest_q(spark, d):
    """S6.1 from the stored densest rows of each chunk."""
    return q_voxels(_stored(spark, d).densest(100))


def voxel_stats_q(spark, d):
    return voxel_stats(_p1_voxels(spark, d))


def voxel_summary_q(spark, d):
    s = voxel_summary(_p1_voxels(spark, d))
    return s.select("voxel_count", "total_points", quantize("avg_points_per_voxel").alias("avg_points_per_voxel"))


def voxel_extents_q(spark, d):
    return voxel_extents(_p1_voxels(spark, d))


def elevation_profile_q(spark, d):
    e = elevation_profile(_p1_voxels(spark, d))
    return e.select("min_elev", "max_elev", quantize("avg_elev").alias("avg_elev"))


def voxel_row_count_q(spark, d):
    return row_count(_p1_voxels(spark, d))


def densest_voxels_q(spark, d):
    top = densest_voxels(_p1_voxels(spark, d), 10)
    return q_voxels(top).select(*VOXEL_COLUMNS, "chunk_id")


def densest_report_q(spark, d):
    return densest_report(_p1_voxels(spark, d), 5)


def voxels_in_box_q(spark, d):
    return q_voxels(voxels_in_box(_p1_voxels(spark, d), voxel_size=LINEITEM.voxel_size,
                                  limit=LINEITEM.box_limit, **LINEITEM.box))


def voxels_in_box_index_q(spark, d):
    return q_voxels(voxels_in_box(_p1_voxels(spark, d), is_voxel_coords=True,
                                  limit=LINEITEM.box_limit, **LINEITEM.index_box))


def voxels_between_q(spark, d):
    return q_voxels(voxels_between(_p1_voxels(spark, d), *LINEITEM.between))


def resume_points_q(spark, d):
    """Voxel rows that the resume recovered (those its run wrote)."""
    return q_voxels(_resumed(spark, d, None).voxels().where("run_seq = 2"))


def resume_store_q(spark, d):
    """Some failed chunks pass the lower floor, others stay out."""
    return q_voxels(_resumed(spark, d, RESUME_FLOOR).voxels())


def resume_append_q(spark, d):
    """Recovered chunks and those of the first run together are the full table."""
    return q_voxels(_resumed(spark, d, None).voxels())


def ledger_after_resume_q(spark, d):
    return _resumed(spark, d, RESUME_FLOOR, EVENTS.resume_max_chunks).ledger()


def run_summary_q(spark, d):
    pts = LINEITEM.points(spark, d)
    log = values_frame(spark, ["key", "value", "version"], ["string", "string", "bigint"], list(LINEITEM.metadata))
    counted = pts.agg(F.lit("point_count").alias("key"), F.count(F.lit(1)).cast("string").alias("value"),
                      F.lit(1).cast("long").alias("version"))
    latest = log.unionByName(counted).groupBy("key").agg(F.max_by("value", "version").alias("value"))
    return run_summary(voxelize_points(pts, LINEITEM.config()), latest)


def layout_roundtrip_q(spark, d):
    """S1.4/S1.5/S1.8/S1.11: write the voxel table in its stored layout under the checkpoint root, read it back."""
    path = scratch_path(spark, "voxel-layout")
    write_voxel_layout(_p1_voxels(spark, d), path)
    return q_voxels(read_voxel_layout(spark, path))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "points_bounds": points_bounds_q,
    "points_in_box": points_in_box_q,
    "chunk_occupancy": chunk_occupancy_q,
    "elevation_filter": elevation_filter_q,
    "chunk_z_stats": chunk_z_stats_q,
    "sigma_filter": sigma_filter_q,
    "voxel_index": voxel_index_q,
    "voxelize_raw": voxelize_raw_q,
    "voxelize_clean": voxelize_clean_q,
    "voxelize_events": voxelize_events_q,
    "voxelize_first_chunks": voxelize_first_chunks_q,
    "chunk_outcomes": chunk_outcomes_q,
    "ingest_totals": ingest_totals_q,
    "stored_totals": stored_totals_q,
    "ingest_store": ingest_store_q,
    "ingest_twice": ingest_twice_q,
    "stored_append": stored_append_q,
    "stored_box_lookup": stored_box_lookup_q,
    "staged_ingest": staged_ingest_q,
    "staged_damage": staged_damage_q,
    "staged_repair": staged_repair_q,
    "stored_reads": stored_reads_q,
    "stored_densest": stored_densest_q,
    "resume_store": resume_store_q,
    "voxel_stats": voxel_stats_q,
    "voxel_summary": voxel_summary_q,
    "voxel_extents": voxel_extents_q,
    "elevation_profile": elevation_profile_q,
    "voxel_row_count": voxel_row_count_q,
    "densest_voxels": densest_voxels_q,
    "densest_report": densest_report_q,
    "voxels_in_box": voxels_in_box_q,
    "voxels_in_box_index": voxels_in_box_index_q,
    "voxels_between": voxels_between_q,
    "resume_points": resume_points_q,
    "resume_append": resume_append_q,
    "ledger_after_resume": ledger_after_resume_q,
    "run_summary": run_summary_q,
    "layout_roundtrip": layout_roundtrip_q,
}
