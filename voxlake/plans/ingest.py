"""Ingest and resume against a :class:`VoxelStore` (S1.4-S1.12, S4.9-S4.11, S11.1-S11.5, S3.1, S7.1-S7.3).

One run: header bounds (skipped when given or stored), one aggregate over the points into the chunk
plan (written, at most G^2 + 1 rows), cleaning and voxelizing of the chunks that did not fail, outcomes
from the rows written, and one small write that publishes all of it. The points are scanned once for
each of the first three; ids of failed chunks and one row of statistics are all the driver holds.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.operators.chunks import Bounds, Grid
from voxlake.operators.clean import maybe_broadcast
from voxlake.operators.outcomes import (chunk_outcomes, chunk_plan, chunk_profile, file_faults, file_profile, merged_profile)
from voxlake.operators.reads import stats_of
from voxlake.operators.recovery import points_of_chunks
from voxlake.plans.build import VoxelConfig, chunk_voxels
from voxlake.schemas import FULL, RESUME
from voxlake.session import discard, scratch_path
from voxlake.sources.points import StagedPoints
from voxlake.sources.store import VoxelStore


@dataclass
class RunResult:
    status: str                      # "success" or "skipped"
    run_seq: int | None = None
    attempted: int = 0
    failed: list[str] = field(default_factory=list)   # ledger after the run
    stats: dict = field(default_factory=dict)


class AllChunksFailed(RuntimeError):
    """Every attempted chunk failed, so the run loaded and published nothing (S11.2)."""


@dataclass
class Read:
    """The points of one attempt.

    Staged points on their own grid are profiled by a tolerant read that is held against the list of their files;
    ``only`` names the attempted chunks in a predicate on the folders. Other points have no files of their own:
    a source that cannot be read ends the run.
    """

    assigned: DataFrame                     # what is voxelized; strict: an unreadable file raises
    staged: StagedPoints | None = None
    only: str = "true"
    written: str | None = None              # scratch folder of the profile

    def profile(self, cfg: VoxelConfig) -> tuple[DataFrame, DataFrame | None]:
        """The chunk profile and, for staged points, the file faults."""
        if self.staged is None:
            return chunk_profile(self.assigned, cfg.z_min, cfg.z_max), None
        path = scratch_path(self.assigned.sparkSession, "file-profile")      # a row for each file; removed by the run
        made = file_profile(self.staged.points(tolerant=True).where(self.only), cfg.z_min, cfg.z_max)
        made.write.parquet(path)
        self.written = path
        files = self.assigned.sparkSession.read.schema(made.schema).parquet(path)
        return merged_profile(files), file_faults(self.staged.files().where(self.only), files)

    def good(self, bad: list[int]) -> DataFrame:
        """The points without those of the chunks ``bad``, whose folders are not opened."""
        if self.staged is None or not bad:
            return self.assigned
        return self.assigned.where(f"chunk NOT IN ({', '.join(map(str, bad))})")


def _read(points: DataFrame | StagedPoints, grid: Grid, only: str = "true") -> Read:
    """Points with their chunk: computed, or the stored folder if they are staged on this grid."""
    if isinstance(points, StagedPoints):
        if points.grid == grid:
            return Read(points.points().where(only), points, only)
        points = points.points().drop("chunk")
    return Read(grid.assign(points).where(only))


def _expected(points: DataFrame | StagedPoints, grid: Grid, manifest: DataFrame | None) -> DataFrame | None:
    """The given manifest, or that of points staged on this grid."""
    return points.manifest() if manifest is None and isinstance(points, StagedPoints) and points.grid == grid else manifest


def _run(spark: SparkSession, read: Read, store: VoxelStore, cfg: VoxelConfig, grid: Grid, selected: DataFrame,
         manifest: DataFrame | None, kind: str, source: str, kept_ledger: list[str], whole_share: float | None) -> RunResult:
    """One attempt of the chunks ``selected``; ``read`` holds their points.

    ``kept_ledger``: failed chunks of earlier runs that this one does not attempt.
    """
    seq = store.next_run_seq()
    # Job: the chunk plan, written once (lineage cut; the rest of the run reads it).
    path = scratch_path(spark, "chunk-plan")
    profile, faults = read.profile(cfg)
    made = chunk_plan(selected, profile, manifest, cfg.share_floor, whole_share, faults)
    made.write.parquet(path)
    plan = spark.read.schema(made.schema).parquet(path)
    row = plan.agg(F.count("chunk").alias("attempted"), F.collect_list(F.when(F.col("error").isNotNull() & F.col("chunk").isNotNull(), F.struct("chunk_id", "chunk"))).alias("bad"),
                   F.max(F.when(F.col("chunk").isNull(), F.col("error"))).alias("outside"),
                   F.expr("sum(if(chunk IS NULL, points_read, 0))").alias("unplaced"),
                   F.expr("CAST(sum(n_z) AS DOUBLE) / sum(points_read)").alias("share")).first()
    bad = sorted(r["chunk_id"] for r in row["bad"])
    if row["attempted"] and len(bad) == row["attempted"]:
        raise AllChunksFailed(f"all {len(bad)} attempted chunks failed; nothing was loaded (S11.2)")

    # Job: clean and voxelize what did not fail, into this run's own folders.
    good = plan.where("error IS NULL AND chunk IS NOT NULL AND points_read > 0")
    store.write_voxels(chunk_voxels(read.good([r["chunk"] for r in row["bad"]]), grid, cfg, stats=good), seq)
    states = store.write_states(seq)
    store.write_outcomes(chunk_outcomes(plan, states.selectExpr("chunk_id", "voxels", "points AS points_kept")), seq)
    for done in filter(None, (path, read.written)):
        discard(spark, done)

    # Ledger (S7.2 / S7.3): (previous - attempted) U failed now; on a full run, failed now.
    ledger = sorted(set(kept_ledger) | set(bad))
    b = grid.bounds
    settings = {"failed_chunks": json.dumps(ledger)}
    if kind == FULL:
        settings |= {
            "voxel_size": float(cfg.voxel_size), "grid_size": int(cfg.grid_size), "source": source,
            "point_count": b.point_count, "filter_outliers": bool(cfg.filter_outliers),
            "z_min_limit": float(cfg.z_min), "z_max_limit": float(cfg.z_max),
            "min_x": b.min_x, "max_x": b.max_x, "min_y": b.min_y, "max_y": b.max_y, "min_z": b.min_z, "max_z": b.max_z,
            "points_unplaced": int(row["unplaced"] or 0), "unplaced_fault": row["outside"] or "",
            "in_range_share": 1.0 if row["share"] is None else float(row["share"]),
        }
    store.publish(seq, kind, settings)
    return RunResult("success", seq, row["attempted"], ledger, stats_of(states if kind == FULL else store.states()).first().asDict())


def ingest(spark: SparkSession, points: DataFrame | StagedPoints, root: str, cfg: VoxelConfig, source: str = "",
           bounds: Bounds | None = None, manifest: DataFrame | None = None) -> RunResult:
    """Full run: a new voxel table and outcome log from ``points``, in place of the old ones (S1.8, S7.3).

    ``manifest`` (``chunk_id, expected_points``) and ``cfg.share_floor`` make chunks fail (S11.1): they are
    left out and listed in the ledger. Staged points bring their header and the list of their files as staged:
    a chunk with a lost, cut, unreadable or changed file fails, with the file in its reason. With
    ``cfg.max_chunks`` only the first N chunks in grid order are processed (S2.11); their points are
    read by literal ranges, or from their folders.
    """
    store = VoxelStore(spark, root)
    if isinstance(points, StagedPoints):
        bounds = bounds or points.grid.bounds
    grid = Grid(bounds or Bounds.of(points), cfg.grid_size)
    manifest = _expected(points, grid, manifest)
    selected, n = grid.chunks(spark), cfg.max_chunks
    if n is not None and int(n) == 0:
        return RunResult("skipped")                       # nothing attempted: tables untouched (S11.4)
    if n is None:
        read = _read(points, grid)
    else:
        selected = selected.where(f"chunk < {int(n)}")
        if isinstance(points, StagedPoints):
            read = _read(points, grid, f"chunk < {int(n)}")
        else:
            read = _read(points.where(grid.first_sql(int(n))), grid)
    return _run(spark, read, store, cfg, grid, selected, manifest, FULL, source, [], None)


def stored_config(store: VoxelStore) -> tuple[VoxelConfig, Bounds, str]:
    meta = store._settings(store.commits())              # a handful of keys
    cfg = VoxelConfig(grid_size=int(meta["grid_size"]), voxel_size=float(meta["voxel_size"]),
                      filter_outliers=meta.get("filter_outliers", "True") == "True",
                      z_min=float(meta.get("z_min_limit", -50.0)), z_max=float(meta.get("z_max_limit", 150.0)))
    bounds = Bounds(*(float(meta[k]) for k in ("min_x", "max_x", "min_y", "max_y", "min_z", "max_z")),
                    point_count=int(meta.get("point_count", 0)))
    return cfg, bounds, meta.get("source", "")


def resume(spark: SparkSession, points: DataFrame | StagedPoints, root: str, cfg: VoxelConfig | None = None,
           source: str | None = None, manifest: DataFrame | None = None,
           max_chunks: int | None = None) -> RunResult:
    """Re-run only the chunks in the ledger and add them (S3.1, S7.1, S11.3).

    The grid is rebuilt from the stored header, so chunk ids mean the same as in the first
    run. A ``cfg`` or ``source`` that disagrees with the stored run is refused (B2); its
    ``share_floor`` may differ. Only the chunks actually attempted leave the ledger (B1). The failed chunks'
    points are found by their assigned chunk; x, y ranges around all of them (a little wider than the
    cells) reach the scan before that, and staged points open only the chunks' folders.
    """
    store = VoxelStore(spark, root)
    store.require()
    stored, bounds, stored_source = stored_config(store)
    if cfg is not None:
        for k in ("grid_size", "voxel_size", "filter_outliers", "z_min", "z_max"):
            if getattr(cfg, k) != getattr(stored, k):
                raise ValueError(f"resume {k}={getattr(cfg, k)!r} differs from the stored run's "
                                 f"{getattr(stored, k)!r}")
    if source is not None and source != stored_source:
        raise ValueError(f"resume source {source!r} differs from the stored run's {stored_source!r}")
    run_cfg = stored.with_(max_chunks=max_chunks, share_floor=None if cfg is None else cfg.share_floor)
    grid = Grid(bounds, run_cfg.grid_size)
    failed = store.ledger().join(maybe_broadcast(grid.chunks(spark), grid.n_chunks), "chunk_id").select("chunk", "chunk_id", "i", "j")
    rows = failed.orderBy("chunk").collect()                                             # the ledger, S3.1, grid order
    todo = rows if max_chunks is None else rows[:int(max_chunks)]                        # S2.11
    if not todo:
        return RunResult("skipped", failed=sorted(r["chunk_id"] for r in rows))          # S11.4
    last = todo[-1]["chunk"]
    selected = failed.where(f"chunk <= {last}").select("chunk", "chunk_id")
    hull = grid.hull_sql(min(r["i"] for r in todo), max(r["i"] for r in todo), min(r["j"] for r in todo), max(r["j"] for r in todo))
    if isinstance(points, StagedPoints):
        read = _read(points, grid, f"chunk IN ({', '.join(str(r['chunk']) for r in todo)})")
    else:
        read = _read(points.where(hull), grid)
        read.assigned = points_of_chunks(read.assigned, selected, grid.n_chunks)
    manifest = _expected(points, grid, manifest)
    share = store._settings(store.commits()).get("in_range_share")
    return _run(spark, read, store, run_cfg, grid, selected, manifest, RESUME, stored_source,
                [r["chunk_id"] for r in rows[len(todo):]], None if share is None else float(share))


def summary(spark: SparkSession, root: str) -> DataFrame:
    """S4.11 / S11.5: stats of the stored table plus the typed run configuration."""
    return VoxelStore(spark, root).summary()


__all__ = ["AllChunksFailed", "RunResult", "ingest", "resume", "summary"]
