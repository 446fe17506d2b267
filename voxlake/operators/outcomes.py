"""Per-chunk outcomes and ingest totals (S4.9, S4.10, S4.12, S11.1, S11.2).

A chunk profile is one partial/final aggregate over the assigned points: rows read,
rows rejected (non-finite), and the count / mean / population std of the in-range z that
the 3-sigma rule needs. The same G^2-row result therefore feeds both the cleaning join and
the outcome table, and the points are scanned once for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.functions import dlit
from voxlake.operators.chunks import VALID_SQL
from voxlake.operators.clean import Z_MAX_LIMIT, Z_MIN_LIMIT
from voxlake.schemas import STATUS_EMPTY, STATUS_FAILED, STATUS_OK


def chunk_profile(assigned: DataFrame, z_min: float = Z_MIN_LIMIT, z_max: float = Z_MAX_LIMIT,
                  key: str = "chunk", also: list = ()) -> DataFrame:
    """Counts of one read of each chunk, plus the z stats of its valid in-range points.

    ``assigned`` holds every row read (valid or not) with its chunk ordinal; rows whose x or y
    cannot be placed have a NULL chunk and form one dataset-level group.
    """
    zin = f"CASE WHEN {VALID_SQL} AND z BETWEEN {dlit(z_min)} AND {dlit(z_max)} THEN z END"
    return assigned.groupBy(key).agg(
        F.expr("count(1) AS points_read"),
        F.expr(f"count_if(NOT {VALID_SQL}) AS points_rejected"),
        F.expr(f"count({zin}) AS n_z"),
        F.expr(f"avg({zin}) AS mean_z"),
        F.expr(f"stddev_pop({zin}) AS std_pop_z"),
        *also,
    )


def file_profile(read: DataFrame, z_min: float = Z_MIN_LIMIT, z_max: float = Z_MAX_LIMIT) -> DataFrame:
    """:func:`chunk_profile` by chunk and file, with the content sum: one scan serves the file check and the profile."""
    from voxlake.sources.points import CONTENT_SQL
    rows = chunk_profile(read.withColumn("of", F.struct("chunk", "file")), z_min, z_max, "of", [F.expr(f"{CONTENT_SQL} AS content")])
    return rows.select("of.*", *[c for c in rows.columns if c != "of"])


def merged_profile(files: DataFrame) -> DataFrame:
    """Chunk profiles from file profiles: counts add up, mean and squared deviations merge by their counts."""
    mean = F.expr("sum(mean_z * n_z) / nullif(sum(n_z), 0)")
    sums = files.groupBy("chunk").agg(*[F.sum(c).alias(c) for c in ("points_read", "points_rejected", "n_z")], mean.alias("mean_z"),
                                      F.expr("collect_list(if(n_z > 0, struct(n_z, mean_z, std_pop_z), NULL)) AS parts"))
    return sums.select("chunk", "points_read", "points_rejected", "n_z", "mean_z", F.expr(
        "sqrt(aggregate(parts, 0D, (a, p) -> a + p.n_z * (p.std_pop_z * p.std_pop_z + (p.mean_z - mean_z) * (p.mean_z - mean_z))) / nullif(n_z, 0))"
    ).alias("std_pop_z"))


def file_faults(listed: DataFrame, files: DataFrame) -> DataFrame:
    """Chunks with a file that is not as it was staged: ``chunk, fault`` (the first such file by name, and how many).

    ``listed``: the file list (``chunk, file, rows, content``); ``files``: :func:`file_profile` of a tolerant
    read. A lost file and one that cannot be read give no rows; a cut one may give a part.
    """
    seen = files.selectExpr("chunk AS c", "file AS f", "points_read", "content AS found")
    both = listed.join(seen, F.expr("chunk <=> c AND file = f"), "full").selectExpr(
        "coalesce(chunk, c) AS chunk", "coalesce(file, f) AS file",
        "CASE WHEN f IS NULL AND rows > 0 THEN 'is lost or unreadable' WHEN file IS NULL THEN 'was not staged' "
        "WHEN points_read <> rows THEN concat('gave ', points_read, ' of ', rows, ' rows') WHEN found <> content THEN 'has other values' END AS what")
    bad = both.where("what IS NOT NULL").groupBy("chunk").agg(F.expr("min(struct(file, what)) AS one"), F.count("*").alias("n"))
    return bad.selectExpr("chunk", "concat('file ', one.file, ' ', one.what, if(n > 1, concat(', and ', n - 1, ' more'), '')) AS fault")


def voxel_counts(voxels: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Voxel rows and points kept per chunk, from the voxel table."""
    return voxels.groupBy(key).agg(
        F.count(F.lit(1)).alias("voxels"),
        F.sum("point_count").alias("points_kept"),
    )


def chunk_plan(chunks: DataFrame, profile: DataFrame, manifest: DataFrame | None = None,
               share_floor: float | None = None, whole_share: float | None = None, faults: DataFrame | None = None) -> DataFrame:
    """S11.1: what one read of the attempted chunks found, and which of them fail, with the reason.

    ``chunks``: attempted chunks (``chunk``, ``chunk_id``), at most G^2 rows; ``profile``:
    :func:`chunk_profile`; ``manifest``: expected rows by ``chunk_id``; ``faults``: :func:`file_faults`. A chunk
    fails if a file of it has a fault, its rows are not as many as expected, or its in-range share lies below ``share_floor`` times that of all rows read
    (``whole_share`` if given: a resume compares with the full run). One row has a NULL chunk: rows that
    no chunk holds. All tables have at most G^2 + 1 rows and are broadcast.
    """
    every = chunks.select("chunk", "chunk_id").unionByName(
        chunks.sparkSession.sql("SELECT CAST(NULL AS INT) AS chunk, CAST(NULL AS STRING) AS chunk_id"))
    p = profile.withColumnRenamed("chunk", "p_chunk")
    out = every.join(F.broadcast(p), F.expr("chunk <=> p_chunk"), "left").drop("p_chunk")
    if manifest is None:
        out = out.withColumn("expected_points", F.expr("CAST(NULL AS BIGINT)"))
        short = "false"
    else:
        m = manifest.selectExpr("chunk_id", "CAST(expected_points AS BIGINT) AS expected_points")
        out = out.join(F.broadcast(m), "chunk_id", "left")
        short = "chunk IS NOT NULL AND coalesce(points_read, 0) <> coalesce(expected_points, 0)"
    if faults is None:
        out = out.withColumn("fault", F.expr("CAST(NULL AS STRING)"))
    else:
        out = out.join(F.broadcast(faults.withColumnRenamed("chunk", "f_chunk")), F.expr("chunk <=> f_chunk"), "left").drop("f_chunk")
    low = "false"
    if share_floor is not None:
        whole = (f"{dlit(whole_share)}" if whole_share is not None
                 else "CAST(sum(n_z) OVER () AS DOUBLE) / sum(points_read) OVER ()")
        low = f"points_read > 0 AND chunk IS NOT NULL AND CAST(n_z AS DOUBLE) / points_read < {dlit(share_floor)} * ({whole})"
    return out.selectExpr(
        "chunk", "chunk_id", "expected_points", "CAST(coalesce(points_read, 0) AS BIGINT) AS points_read",
        "CAST(coalesce(points_rejected, 0) AS BIGINT) AS points_rejected", "n_z", "mean_z", "std_pop_z",
        f"CASE WHEN fault IS NOT NULL THEN fault WHEN {short} THEN concat('read ', coalesce(points_read, 0), ' of ', coalesce(expected_points, 0), ' rows') "
        f"WHEN {low} THEN 'in-range share below the floor' END AS error")


def chunk_outcomes(plan: DataFrame, vcounts: DataFrame) -> DataFrame:
    """S4.10: one row per attempted chunk with counts, ``ok`` / ``empty`` / ``failed`` and the reason.

    ``plan``: :func:`chunk_plan`; ``vcounts``: :func:`voxel_counts` of what was written. Failed chunks
    load nothing, so their voxel columns are 0.
    """
    return plan.where("chunk IS NOT NULL").join(F.broadcast(vcounts), "chunk_id", "left").selectExpr(
        "chunk_id", "expected_points", "points_read", "points_rejected",
        "CAST(coalesce(points_kept, 0) AS BIGINT) AS points_kept", "CAST(coalesce(voxels, 0) AS BIGINT) AS voxels",
        f"CASE WHEN error IS NOT NULL THEN '{STATUS_FAILED}' WHEN points_read = 0 THEN '{STATUS_EMPTY}' "
        f"ELSE '{STATUS_OK}' END AS status", "error")


def ingest_totals(outcomes: DataFrame) -> DataFrame:
    """S4.9 / S4.12: points read before filtering (loaded chunks only), voxel rows, ratio, chunk states."""
    loaded = f"status <> '{STATUS_FAILED}'"
    return outcomes.selectExpr(
        f"CAST(sum(CASE WHEN {loaded} THEN points_read ELSE 0 END) AS BIGINT) AS total_points_read",
        f"CAST(sum(CASE WHEN {loaded} THEN points_kept ELSE 0 END) AS BIGINT) AS total_points_kept",
        "CAST(sum(voxels) AS BIGINT) AS total_voxels",
        f"count_if(status = '{STATUS_OK}') AS chunks_ok",
        f"count_if(status = '{STATUS_EMPTY}') AS chunks_empty",
        f"count_if(status = '{STATUS_FAILED}') AS chunks_failed",
        f"sum(CASE WHEN {loaded} THEN points_read ELSE 0 END) / nullif(sum(voxels), 0) AS points_per_voxel",
    )
