"""Voxel store on Parquet (S1.4-S1.12, S1.9, S1.10; B3, B4, B6).

Layout under one root folder (shared storage on a cluster):

- ``voxels/run_seq=N/chunk_id=i_j/*.parquet`` -- voxel rows of run N, by chunk and sorted along a Z-order curve of
  ``(voxel_x, voxel_y, voxel_z)`` inside each file, so Parquet row-group min/max statistics
  act as the coordinate index in every direction (S1.11).
- ``outcomes/run_seq=N`` -- one row per chunk that run N attempted.
- ``states/run_seq=N``, ``densest/run_seq=N`` -- partial states of run N's rows by chunk, and the 100 densest rows of
  each chunk: the table reads (S4.4-S4.8, S6.1) merge these and open no voxel file.
- ``appended/base=N/load=.../chunk_id=...`` -- rows loaded outside any run, on top of full run N; ``loads/base=N``
  holds their states, one append for each load, and **readers see only the loads it names**.
- ``commits/`` -- one row per published run, with its settings. **Readers see only what it names**: the
  last full run and the resumes after it.
- ``metadata/`` -- append-only key/value log beside the runs' settings; the newest value wins (S1.9).

A run writes into folders of its own number and publishes itself by one last append to
``commits``. A run that dies before that leaves nothing a reader sees, whether it was the first,
a full one or a resume; the next run takes the same number and overwrites its folders (S1.12, B3).
A chunk shows the rows of its latest outcome, and only if that is ``ok`` (B6).
"""

from __future__ import annotations

import math
import os
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.functions.exprs import with_curve
from voxlake.operators.clean import maybe_broadcast
from voxlake.operators.outcomes import ingest_totals
from voxlake.operators.recovery import ledger_from_outcomes
from voxlake.schemas import (COMMIT_SCHEMA, FULL, INDEX_COLUMNS, LOAD_SCHEMA, METADATA_SCHEMA, OUTCOME_SCHEMA, STATE_SCHEMA,
                             STATUS_OK, STORED_VOXEL_SCHEMA, VOXEL_COLUMNS)
from voxlake.session import discard
from voxlake.sources.values import empty_frame, sql_literal, values_frame

# Row groups of this many bytes: what the statistics of a box lookup can skip.
ROW_GROUP_BYTES = 16 << 20
# Rows per output file; keeps files bounded even for a chunk with a third of all voxels.
MAX_RECORDS_PER_FILE = 4_000_000
# A box lookup looks at grid columns of about this many rows at first, then at twice as many.
STEP_ROWS = 1_000_000


def _read(spark: SparkSession, schema, *paths: str, base: str | None = None) -> DataFrame | None:
    """Parquet folders with a fixed schema, or None when one does not exist."""
    try:
        reader = spark.read.schema(schema)
        return (reader.option("basePath", base) if base else reader).parquet(*paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def write_voxel_layout(voxels: DataFrame, path: str, num_partitions: int | None = None, order: str = "index",
                       row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Write voxel rows partitioned by ``chunk_id``, each file in ``order``; replaces ``path``.

    The ``REBALANCE(chunk_id)`` hint lets AQE size the writer tasks at run time: small
    chunks are coalesced into one task, and a chunk holding a large share of the voxels is
    split over several tasks instead of landing in one (a plain hash repartition on
    ``chunk_id`` would put it in a single task). No sampling pass is needed, unlike a range
    repartition. ``maxRecordsPerFile`` bounds files. A retried write leaves the same rows once (S1.12).

    ``order``: ``index`` sorts by ``(voxel_x, voxel_y, voxel_z)`` (S6.5), whose row-group statistics skip for bounds on x
    alone; ``curve`` sorts along a Z-order curve of the three, so that a row group is a small box in all directions
    and bounds on y or z skip as well (S1.11). The curve's key is not stored.
    """
    rows = voxels.select(*VOXEL_COLUMNS, "chunk_id")
    rows = rows.hint("rebalance", num_partitions, "chunk_id") if num_partitions else rows.hint("rebalance", "chunk_id")
    if order == "curve":
        rows = with_curve(rows, INDEX_COLUMNS, "curve").sortWithinPartitions("chunk_id", "curve").drop("curve")
    elif order == "index":
        rows = rows.sortWithinPartitions("chunk_id", *INDEX_COLUMNS)
    else:
        raise ValueError(f"order must be 'index' or 'curve', got {order!r}")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .option("parquet.block.size", row_group_bytes).partitionBy("chunk_id").parquet(path))


def read_voxel_layout(spark: SparkSession, path: str) -> DataFrame:
    """Read a voxel folder with its fixed schema; a missing folder is an error (S2.15)."""
    df = _read(spark, STORED_VOXEL_SCHEMA, path)
    if df is None:
        raise FileNotFoundError(f"voxel table not found at {path}; run an ingest first")
    return df.drop("run_seq")


class VoxelStore:
    """The stored tables of one point set."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        (self.voxels_path, self.outcomes_path, self.metadata_path, self.commits_path, self.appended_path, self.states_path,
         self.densest_path, self.loads_path) = (
            os.path.join(root, d) for d in ("voxels", "outcomes", "metadata", "commits", "appended", "states", "densest", "loads"))

    # -- published runs ----------------------------------------------------------------------
    def commits(self) -> list[dict]:
        """Published runs in order: one row each, a handful."""
        df = _read(self.spark, COMMIT_SCHEMA, self.commits_path)
        return [] if df is None else sorted((r.asDict() for r in df.collect()), key=lambda r: r["run_seq"])

    @staticmethod
    def live(commits: list[dict]) -> list[int]:
        """Numbers of the last full run and the resumes after it."""
        seqs: list[int] = []
        for c in commits:
            seqs = [c["run_seq"]] if c["kind"] == FULL else [*seqs, c["run_seq"]]
        return seqs

    def next_run_seq(self) -> int:
        return max((c["run_seq"] for c in self.commits()), default=0) + 1

    def publish(self, run_seq: int, kind: str, metadata: dict) -> None:
        """The one write that makes run ``run_seq`` visible, with its settings as text (S8.7)."""
        pairs = ", ".join(f"{sql_literal(str(k))}, {sql_literal(_as_text(v))}" for k, v in metadata.items())
        row = self.spark.range(1).selectExpr(
            f"{int(run_seq)}L AS run_seq", f"'{kind}' AS kind", f"{time.time_ns()}L AS version",
            f"CAST(map({pairs}) AS MAP<STRING, STRING>) AS metadata")
        row.coalesce(1).write.mode("append").parquet(self.commits_path)

    def exists(self) -> bool:
        return any(_read(self.spark, schema, path) is not None
                   for schema, path in ((COMMIT_SCHEMA, self.commits_path), (LOAD_SCHEMA, self.loads_path)))

    def require(self) -> None:
        if not self.exists():
            raise FileNotFoundError(f"no voxel store at {self.root}; run an ingest first")

    # -- voxels ------------------------------------------------------------------------------
    def write_voxels(self, voxels: DataFrame, run_seq: int) -> None:
        """Write the voxel rows of run ``run_seq`` into its own folder (not visible before publish)."""
        # A run of this number that died may have left loads (a compaction copies them before it publishes).
        for path in (self.loads_path, self.appended_path):
            discard(self.spark, os.path.join(path, f"base={int(run_seq)}"))
        write_voxel_layout(voxels, self._run_folder(self.voxels_path, run_seq), order="curve")

    def write_states(self, run_seq: int) -> DataFrame:
        """Partial states and densest rows of what run ``run_seq`` wrote; gives its states."""
        from voxlake.operators.reads import chunk_states, densest_by_chunk
        rows = self.run_voxels(run_seq)
        chunk_states(rows).write.mode("overwrite").parquet(self._run_folder(self.states_path, run_seq))
        densest_by_chunk(rows.drop("run_seq")).write.mode("overwrite").parquet(self._run_folder(self.densest_path, run_seq))
        return self._runs(self.states_path, STATE_SCHEMA, [run_seq])

    def run_voxels(self, run_seq: int) -> DataFrame:
        """The rows that run ``run_seq`` wrote, published or not."""
        return self._runs(self.voxels_path, STORED_VOXEL_SCHEMA, [run_seq])

    def voxels(self) -> DataFrame:
        """Visible voxel rows: each chunk's rows of its latest outcome if that is ``ok`` (B6), and the
        rows appended since the last full run. The outcome table has at most G^2 rows and is broadcast."""
        commits = self.commits()
        return self._visible(commits, self._runs(self.voxels_path, STORED_VOXEL_SCHEMA, self.live(commits)))

    def _latest(self, commits: list[dict], rows: DataFrame) -> DataFrame:
        """Of rows of the live runs (``chunk_id, run_seq``), those of each chunk's latest outcome, if that is ``ok``."""
        if not commits:
            self.require()
        if len(self.live(commits)) > 1:       # a later run may have replaced a chunk
            latest = (self.outcomes(commits).groupBy("chunk_id")
                      .agg(F.max_by("status", "run_seq").alias("status"), F.max("run_seq").alias("run_seq")))
            latest = latest.where(f"status = '{STATUS_OK}'").select("chunk_id", "run_seq")
            rows = rows.join(maybe_broadcast(latest, self._chunk_bound(commits)), ["chunk_id", "run_seq"], "left_semi")
        return rows

    def _visible(self, commits: list[dict], rows: DataFrame) -> DataFrame:
        rows = self._latest(commits, rows).select(*STORED_VOXEL_SCHEMA.fieldNames())
        appended = self._appended(commits)
        return rows if appended is None else rows.unionByName(appended)

    def states(self) -> DataFrame:
        """Partial states of the visible rows: a row for each chunk and run or load, no voxel file is opened."""
        commits = self.commits()
        rows, loads = self._run_states(commits), self._loads(commits)
        return rows if loads is None else rows.unionByName(loads.select(*rows.columns))

    def _run_states(self, commits: list[dict]) -> DataFrame:
        """The states of the visible rows of the live runs, without loads."""
        from voxlake.operators.reads import chunk_states
        parts = []
        for s in self.live(commits):
            found = _read(self.spark, STATE_SCHEMA, self._run_folder(self.states_path, s), base=self.states_path)
            # A run written without states (by an earlier version) is read whole.
            parts.append(chunk_states(self.run_voxels(s)).withColumn("run_seq", F.lit(s).cast("long")) if found is None else found)
        rows = parts[0] if parts else empty_frame(self.spark, STATE_SCHEMA)
        for f in parts[1:]:
            rows = rows.unionByName(f)
        return self._latest(commits, rows).select(*[f for f in STATE_SCHEMA.fieldNames() if f != "run_seq"])

    def _densest(self) -> DataFrame:
        """The densest rows of each chunk and run or load, of those that are visible."""
        from voxlake.operators.reads import densest_by_chunk
        commits = self.commits()
        rows = empty_frame(self.spark, STORED_VOXEL_SCHEMA)
        for s in self.live(commits):
            found = _read(self.spark, STORED_VOXEL_SCHEMA, self._run_folder(self.densest_path, s), base=self.densest_path)
            rows = rows.unionByName(densest_by_chunk(self.run_voxels(s)) if found is None else found)
        rows = self._latest(commits, rows).select(*STORED_VOXEL_SCHEMA.fieldNames())
        loads = self._load_rows(commits, self.densest_path)
        return rows if loads is None else rows.unionByName(loads)

    def _loads(self, commits: list[dict]) -> DataFrame | None:
        return _read(self.spark, LOAD_SCHEMA, os.path.join(self.loads_path, f"base={self._base(commits)}"))

    def _load_names(self, commits: list[dict]) -> list[str]:
        """The published loads on top of the last full run: one name for each append."""
        loads = self._loads(commits)
        return [] if loads is None else sorted(r["load"] for r in loads.select("load").distinct().collect())

    def _load_rows(self, commits: list[dict], folder: str) -> DataFrame | None:
        """Rows of the published loads under ``folder``."""
        names = self._load_names(commits)
        if not names:
            return None
        rows = _read(self.spark, STORED_VOXEL_SCHEMA, *(os.path.join(folder, f"load={x}") for x in names), base=folder)
        return rows.select(*STORED_VOXEL_SCHEMA.fieldNames())

    def _appended(self, commits: list[dict]) -> DataFrame | None:
        return self._load_rows(commits, os.path.join(self.appended_path, f"base={self._base(commits)}"))

    def append_voxels(self, voxels: DataFrame, chunk_id: str = "loaded") -> None:
        """S1.6: bulk append of voxel rows (``chunk_id`` column, or the given id); empty -> no-op. The last write, of
        the load's states, makes it visible, so a load that dies or is tried again shows once or not at all."""
        if voxels.isEmpty():
            return
        rows = voxels if "chunk_id" in voxels.columns else voxels.withColumn("chunk_id", F.lit(chunk_id))
        self._load(rows, self._base(self.commits()))

    def _load(self, rows: DataFrame, base: int) -> None:
        from voxlake.operators.reads import chunk_states, densest_by_chunk
        load = uuid.uuid4().hex
        path = os.path.join(self.appended_path, f"base={base}", f"load={load}")
        rows.select(*VOXEL_COLUMNS, F.lit(None).cast("long").alias("run_seq"), "chunk_id").write.partitionBy("chunk_id").parquet(path)
        written = _read(self.spark, STORED_VOXEL_SCHEMA, path)
        densest_by_chunk(written).write.parquet(os.path.join(self.densest_path, f"load={load}"))
        (chunk_states(written).withColumn("load", F.lit(load)).write.mode("append")
         .parquet(os.path.join(self.loads_path, f"base={base}")))

    def create(self) -> "VoxelStore":
        """S1.7: create the empty tables if absent (existing tables are left as they are)."""
        if not self.exists():
            empty_frame(self.spark, COMMIT_SCHEMA).write.parquet(self.commits_path)
        return self

    def reset(self) -> None:
        """S1.8: empty the voxel table and its outcomes (an empty full run); metadata is kept."""
        self.publish(self.next_run_seq(), FULL, {})

    def _base(self, commits: list[dict]) -> int:
        return (self.live(commits) or [0])[0]

    @staticmethod
    def _run_folder(path: str, run_seq: int) -> str:
        return os.path.join(path, f"run_seq={int(run_seq)}")

    def _runs(self, path: str, schema, seqs: list[int]) -> DataFrame:
        """Rows of the given runs; an empty full run has no folder."""
        frames = [f for s in seqs if (f := _read(self.spark, schema, self._run_folder(path, s), base=path)) is not None]
        out = frames[0] if frames else empty_frame(self.spark, schema)
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def _chunk_bound(self, commits: list[dict]) -> int:
        g = self._settings(commits).get("grid_size")
        return int(g) ** 2 if g is not None else 1 << 62

    # -- outcomes and ledger -----------------------------------------------------------------
    def outcomes(self, commits: list[dict] | None = None) -> DataFrame:
        """Outcomes of the last full run and the resumes after it, one row per chunk and run."""
        live = self.live(self.commits() if commits is None else commits)
        return self._runs(self.outcomes_path, OUTCOME_SCHEMA, live).select(*OUTCOME_SCHEMA.fieldNames())

    def latest_outcomes(self) -> DataFrame:
        """The latest outcome of each chunk."""
        return (self.outcomes().groupBy("chunk_id")
                .agg(F.max_by(F.struct(*OUTCOME_SCHEMA.fieldNames()), "run_seq").alias("o")).select("o.*"))

    def write_outcomes(self, outcomes: DataFrame, run_seq: int) -> None:
        outcomes.select(*[c for c in OUTCOME_SCHEMA.fieldNames() if c != "run_seq"]).write.mode("overwrite").parquet(
            self._run_folder(self.outcomes_path, run_seq))

    def ledger(self) -> DataFrame:
        """Failed-chunk ledger as data: chunks whose latest outcome is ``failed``."""
        return ledger_from_outcomes(self.outcomes())

    def totals(self) -> DataFrame:
        """S4.9 / S4.12 of the stored table: points read and kept, voxels, chunk states, ratio."""
        return ingest_totals(self.latest_outcomes())

    # -- metadata ----------------------------------------------------------------------------
    def _settings(self, commits: list[dict]) -> dict[str, str]:
        """Settings of the published runs, the newest value of each key."""
        out: dict[str, str] = {}
        for c in commits:
            out |= c["metadata"] or {}
        return out

    def metadata_log(self) -> DataFrame:
        """Every value ever set, by runs and by hand: ``key, value, version``."""
        log = _read(self.spark, METADATA_SCHEMA, self.metadata_path)
        runs = _read(self.spark, COMMIT_SCHEMA, self.commits_path)
        parts = [f for f in (log, None if runs is None else runs.selectExpr("explode(metadata) AS (key, value)", "version")) if f is not None]
        if not parts:
            return empty_frame(self.spark, METADATA_SCHEMA)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def metadata(self) -> DataFrame:
        """Latest value per key (INSERT OR REPLACE semantics over append-only logs)."""
        return self.metadata_log().groupBy("key").agg(F.max_by("value", "version").alias("value"))

    def set_metadata(self, values: dict) -> None:
        """Append one version of each key; values are stored as text like ``str(v)`` (S8.7)."""
        version = time.time_ns()
        rows = [(str(k), _as_text(v), version) for k, v in values.items()]
        (values_frame(self.spark, ["key", "value", "version"], ["string", "string", "bigint"], rows)
         .coalesce(1).write.mode("append").parquet(self.metadata_path))

    def box_voxels(self, min_x=None, max_x=None, min_y=None, max_y=None, min_z=None, max_z=None,
                   is_voxel_coords: bool = False, limit: int = 1000) -> DataFrame:
        """Box lookup on the stored table (S2.7-S2.9, S6.3) with chunk-partition pruning.

        The stored grid tells which chunk rows and columns can hold voxels of the box; they become
        ranges on the parts of ``chunk_id``, a partition filter, with a voxel to spare on each side (cell
        edges and the chunk of a point round differently). The index predicate stays exact, and its
        bounds reach the Parquet scan, where row groups are skipped. Rows appended outside any run lie
        elsewhere and are not pruned. Of a box with far more rows than the limit only the first grid
        columns are read (:meth:`_first_columns`).
        """
        from voxlake.operators.reads import BOX_MAX, _check_limit, index_bounds, voxels_in_box
        limit = _check_limit(limit, BOX_MAX, "box")
        commits = self.commits()
        size = float(self.get_metadata("voxel_size", "2.0"))
        bounds = index_bounds(min_x, max_x, min_y, max_y, min_z, max_z, is_voxel_coords, size)
        rows = self._near(commits, self._runs(self.voxels_path, STORED_VOXEL_SCHEMA, self.live(commits)), bounds)
        rows = self._first_columns(commits, rows, bounds, limit)
        return voxels_in_box(self._visible(commits, rows), min_x, max_x, min_y, max_y, min_z, max_z, is_voxel_coords, size, limit)

    def _near(self, commits: list[dict], rows: DataFrame, bounds: dict) -> DataFrame:
        """``rows`` of the chunks that can hold voxels of the box, by the stored grid."""
        meta = self._settings(commits)
        if not all(k in meta for k in ("grid_size", "voxel_size", "min_x", "max_x", "min_y", "max_y")):
            return rows
        g, size = int(meta["grid_size"]), float(meta["voxel_size"])
        for part, axis in ((0, "x"), (1, "y")):
            lo, hi = bounds[f"min_{axis}"], bounds[f"max_{axis}"]
            first, last = float(meta[f"min_{axis}"]), float(meta[f"max_{axis}"])
            step = (last - first) / g
            near = [k for k in range(g)
                    if (lo is None or math.floor((first + (k + 1) * step) / size) + 1 >= lo)
                    and (hi is None or math.floor((first + k * step) / size) - 1 <= hi)]
            if step > 0 and len(near) < g:      # g is at most MAX_GRID; the cells are consecutive
                rows = rows.where(f"CAST(split(chunk_id, '_')[{part}] AS INT) BETWEEN {near[0]} AND {near[-1]}"
                                  if near else "false")
        return rows

    def _first_columns(self, commits: list[dict], rows: DataFrame, bounds: dict, limit: int) -> DataFrame:
        """S6.3: ``rows`` of the first grid columns only, as soon as they fill the limit (loads included) and no row
        of a later column can come before the last of them.

        The stored states tell each column's rows and lowest voxel_x (a row for each column, at most MAX_GRID, on the
        driver). Columns of ``STEP_ROWS`` rows are looked at first, then of twice as many; boxes that cannot
        hold more than that are read at once, without a look.
        """
        from voxlake.operators.reads import box_state_predicate, ordered_box
        if "grid_size" not in self._settings(commits):      # chunk ids name no columns
            return rows
        column = "CAST(split(chunk_id, '_')[0] AS INT)"
        found = (self._run_states(commits).where(box_state_predicate(bounds)).groupBy(F.expr(column).alias("i"))
                 .agg(F.min("x_min").alias("low"), F.sum("voxels").alias("n")).orderBy("i").collect())
        later = [math.inf] * (len(found) + 1)               # the lowest voxel_x from a column on
        for k in range(len(found) - 1, -1, -1):
            later[k] = min(later[k + 1], found[k]["low"])
        seen, held, goal = 0, 0, max(limit, STEP_ROWS)
        while True:
            while seen < len(found) and held < goal:
                held += found[seen]["n"]
                seen += 1
            if seen == len(found):
                return rows
            some = rows.where(f"{column} <= {found[seen - 1]['i']}")
            full = (ordered_box(self._visible(commits, some), bounds, limit)
                    .agg(F.count("*").alias("n"), F.max("voxel_x").alias("x")).first())
            if full["n"] == limit and full["x"] < later[seen]:
                return some.where(f"voxel_x <= {full['x']}")
            goal = held * 2

    def compact(self) -> None:
        """Rewrite what is visible as one full run, published at once: voxels, appended rows, latest
        outcomes and settings. Older folders are no longer read."""
        commits = self.commits()
        seq = self.next_run_seq()
        appended = self._appended(commits)
        rows = self.voxels().where("run_seq IS NOT NULL")
        self.write_voxels(rows.drop("run_seq"), seq)
        self.write_outcomes(self.latest_outcomes(), seq)
        self.write_states(seq)
        if appended is not None:
            self._load(appended, seq)
        self.publish(seq, FULL, self._settings(commits))

    # -- the read endpoints and verification, over the stored table: from partial states, no voxel is read ----------
    def stats(self) -> DataFrame:
        """Rows, points and index ranges (S4.4)."""
        from voxlake.operators.reads import stats_of
        return stats_of(self.states())

    def voxel_summary(self) -> DataFrame:
        """Rows, points, points per row (S4.5)."""
        from voxlake.operators.reads import summary_of
        return summary_of(self.states())

    def extents(self) -> DataFrame:
        """Extremes of each index (S4.6)."""
        from voxlake.operators.reads import extents_of
        return extents_of(self.states())

    def elevation_profile(self) -> DataFrame:
        """Lowest, highest and mean elevation (S4.7)."""
        from voxlake.operators.reads import profile_of
        return profile_of(self.states())

    def row_count(self) -> DataFrame:
        """Number of voxel rows (S4.8)."""
        from voxlake.operators.reads import count_of
        return count_of(self.states())

    def summary(self) -> DataFrame:
        """Table stats plus the typed run configuration (S4.11)."""
        from voxlake.operators.reads import run_summary
        return run_summary(None, self.metadata(), self.stats())

    def densest(self, limit: int = 10) -> DataFrame:
        """Top-N voxel rows by point count (S6.1), from the stored densest rows of each chunk (N is at most their number)."""
        from voxlake.operators.reads import densest_voxels
        return densest_voxels(self._densest(), limit)

    def densest_report(self, limit: int = 5) -> DataFrame:
        """Top-5 report with rounded elevations (S6.2)."""
        from voxlake.operators.reads import densest_report
        return densest_report(self._densest(), limit)

    def report(self) -> str:
        """The four verification queries, formatted (S1.14)."""
        from voxlake.plans.report import format_tables
        return format_tables(self.voxel_summary(), self.extents(), self.elevation_profile(), self.densest_report())

    def get_metadata(self, key: str, default: str | None = None) -> str | None:
        """Point lookup with default (S1.10); a missing key gives the default, errors propagate."""
        if _read(self.spark, METADATA_SCHEMA, self.metadata_path) is None:     # runs' settings alone: no job but the commits'
            return self._settings(self.commits()).get(key, default)
        row = self.metadata().where(F.col("key") == key).select("value").first()
        return default if row is None else row["value"]


def _as_text(v) -> str:
    if isinstance(v, bool):
        return "True" if v else "False"
    return str(v)
