"""Resume selection and failed-chunk ledger algebra (S2.11, S3.1, S3.2, S7.2, S7.3, S11.3).

All inputs here are chunk lists (at most G^2 rows). They are joined to points only through a
broadcast semi-join on the int chunk ordinal, after a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.operators.clean import maybe_broadcast


def select_chunks(chunks: DataFrame, failed: DataFrame | None = None,
                  max_chunks: int | None = None, n_chunks_bound: int | None = None) -> DataFrame:
    """Chunks to attempt: the resume filter first (S3.1), then the first N in grid order (S2.11).

    ``chunks`` has ``chunk`` (ordinal, i.e. grid order) and ``chunk_id``; ``failed`` has ``chunk_id``.
    The distinct failed ids are broadcast when ``n_chunks_bound`` (G^2) proves them small;
    without a bound the join strategy is left to AQE's runtime statistics.
    """
    sel = chunks
    if failed is not None:
        ids = failed.select("chunk_id").distinct()
        ids = maybe_broadcast(ids, n_chunks_bound) if n_chunks_bound is not None else ids
        sel = sel.join(ids, "chunk_id", "left_semi")
    if max_chunks is not None:
        if int(max_chunks) < 0:
            raise ValueError("max_chunks must be >= 0")
        sel = sel.orderBy("chunk").limit(int(max_chunks))
    return sel


def points_of_chunks(points: DataFrame, selected: DataFrame, n_chunks_bound: int) -> DataFrame:
    """Keep the points of the selected chunks: broadcast left-semi join on the int ordinal."""
    return points.join(maybe_broadcast(selected.select("chunk"), n_chunks_bound), "chunk", "left_semi")


def ledger_update(previous: DataFrame, attempted: DataFrame, failed_now: DataFrame) -> DataFrame:
    """S7.2: (previous - attempted) U failed again, without duplicates.

    Only chunks actually attempted leave the ledger, so a resume with a chunk limit keeps
    the unattempted ones (fixes the reference's loss of them, B1).
    """
    kept = previous.select("chunk_id").join(attempted.select("chunk_id"), "chunk_id", "left_anti")
    return kept.unionByName(failed_now.select("chunk_id")).dropDuplicates(["chunk_id"])


def ledger_from_outcomes(outcomes_log: DataFrame) -> DataFrame:
    """Ledger as data: chunks whose latest outcome (highest ``run_seq``) is ``failed``.

    Equal to :func:`ledger_update` applied run after run, since attempted chunks get a new
    latest outcome and unattempted ones keep theirs.
    """
    latest = outcomes_log.groupBy("chunk_id").agg(F.max_by("status", "run_seq").alias("status"))
    return latest.where(F.col("status") == "failed").select("chunk_id")
