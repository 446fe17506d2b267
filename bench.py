"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm the JVM and caches, then timed ``BENCH_REPS`` times with a
``noop`` sink (the whole plan executes, nothing is collected); the median is reported.
``flagship_exec_sec`` re-executes one built flagship plan (header known): engine time only,
reported next to, not instead of, the end-to-end ``voxelize_clean`` time.
``ingest_full`` and ``ingest_and_resume`` run the stored-table jobs end to end (writes included)
into a fresh folder under the checkpoint root.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from voxlake.plans.build import voxelize_points  # noqa: E402
from voxlake.plans.catalog import EVENTS, LINEITEM, QUERIES, RESUME_FLOOR, SHARE_FLOOR, q_voxels  # noqa: E402
from voxlake.plans.ingest import ingest, resume  # noqa: E402
from voxlake.operators.chunks import Bounds  # noqa: E402
from voxlake.session import scratch_path  # noqa: E402
from voxlake.sources.store import VoxelStore  # noqa: E402

HEADLINE = [
    "voxelize_clean", "voxelize_events", "voxelize_raw", "voxelize_first_chunks", "chunk_outcomes",
    "points_bounds", "points_in_box", "chunk_occupancy", "voxel_stats", "densest_voxels", "voxels_in_box", "run_summary",
]


def session(cpus: str) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cpus}]").appName("voxlake-bench")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(max(2, int(cpus) if cpus.isdigit() else 8)))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.session.timeZone", "UTC"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.getCheckpointDir() is None and not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="voxlake-bench-"))
    return spark


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, reps: int) -> float:
    fn()                                     # warm-up
    ts = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn()
        ts.append(time.perf_counter() - t0)
    return statistics.median(ts)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "5"))
    spark = session(cpus)
    times: dict[str, float] = {}
    for key in HEADLINE:
        times[key] = round(timed(lambda k=key: run_noop(QUERIES[k](spark, sf_dir)), reps), 3)

    p1 = LINEITEM.points(spark, sf_dir)
    n_points = p1.count()
    # Execution only: the flagship plan built once (header known), executed again each time.
    flagship = q_voxels(voxelize_points(p1, LINEITEM.config(), Bounds.of(p1)))
    exec_only = round(timed(lambda: run_noop(flagship), reps), 3)

    def full_ingest():
        ingest(spark, p1, scratch_path(spark, "bench-store"), LINEITEM.config(), source="lineitem")

    times["ingest_full"] = round(timed(full_ingest, reps), 3)

    ev = EVENTS.points(spark, sf_dir)

    def ingest_then_resume():
        root = scratch_path(spark, "bench-resume")
        ingest(spark, ev, root, EVENTS.config(share_floor=SHARE_FLOOR), source="events")
        resume(spark, ev, root, cfg=EVENTS.config(share_floor=RESUME_FLOOR))

    times["ingest_and_resume"] = round(timed(ingest_then_resume, reps), 3)

    # Over a stored table: bulk load of its voxel rows into another store, and the pruned box lookup.
    root = scratch_path(spark, "bench-stored")
    ingest(spark, p1, root, LINEITEM.config(), source="lineitem")
    store = VoxelStore(spark, root)
    rows = store.voxels().drop("run_seq", "chunk_id")
    times["voxel_load"] = round(timed(lambda: VoxelStore(spark, scratch_path(spark, "bench-load")).append_voxels(rows), reps), 3)
    times["stored_box_lookup"] = round(timed(lambda: run_noop(store.box_voxels(limit=1000, **LINEITEM.box)), reps), 3)

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_headline_sec", "value": total, "unit": "sec", "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus, "reps": reps,
        "flagship_points": n_points,
        "flagship_points_per_sec": round(n_points / times["voxelize_clean"]) if times["voxelize_clean"] else None,
        "flagship_exec_sec": exec_only,
        "flagship_exec_points_per_sec": round(n_points / exec_only) if exec_only else None,
        "ingest_points_per_sec": round(n_points / times["ingest_full"]) if times["ingest_full"] else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
