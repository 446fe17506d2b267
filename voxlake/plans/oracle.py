"""DuckDB oracle SQL for the registered queries (same formulas, written independently as SQL).

Conventions shared with :mod:`voxlake.plans.catalog`:
- float aggregates whose bits depend on merge order are compared after
  ``floor(v * 2^16 + 0.5) / 2^16`` on both sides (exact binary arithmetic);
- DuckDB ``floor`` returns DOUBLE and ``sum(BIGINT)`` HUGEINT, so both are cast to BIGINT.
"""

from __future__ import annotations

from dataclasses import replace

from voxlake.plans.catalog import EMBED, EVENTS, LINEITEM, RESUME_FLOOR, SHARE_FLOOR, PointView


def _f(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def q6(expr: str) -> str:
    """Same binary compare-grid as :func:`voxlake.functions.quantize` (2^-16)."""
    return f"(floor(({expr}) * 65536.0 + 0.5) / 65536.0)"


def r2(expr: str) -> str:
    return f"(sign({expr}) * floor(abs({expr}) * 100.0 + 0.5) / 100.0)"


def points_sql(view: PointView) -> str:
    if view.table == "lineitem":
        return ("SELECT l_orderkey, CAST(l_partkey AS DOUBLE) AS x, "
                "CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS y, "
                "l_extendedprice * l_discount / 50 - 52 AS z FROM lineitem")
    if view.table == "events":
        return ("SELECT event_id, CAST(user_id AS DOUBLE) AS x, "
                "(epoch_us(ts) - 1704067200000000) / 3.6e9 AS y, "
                "value * 0.5 - 52 AS z FROM events")
    if view.table == "embeddings":
        return ("SELECT vec_id, 100 * CAST(embedding[1] AS DOUBLE) AS x, "
                "100 * CAST(embedding[2] AS DOUBLE) AS y, "
                "100 * CAST(embedding[3] AS DOUBLE) AS z FROM embeddings")
    raise ValueError(view.table)


def _cell(c: str, lo: str, step: str, g: int) -> str:
    return f"(CASE WHEN {step} > 0 THEN least(CAST(floor(({c} - {lo}) / {step}) AS BIGINT), {g - 1}) ELSE 0 END)"


def base_ctes(view: PointView, src: str | None = None) -> str:
    """pts -> header bounds -> grid steps -> chunk assignment of every row (``ch``).

    ``src`` replaces the point source; bounds always come from the full view, like a header.
    """
    g = view.grid
    return f"""
pts AS ({points_sql(view)}),
hdr AS (SELECT min(x) AS mnx, max(x) AS mxx, min(y) AS mny, max(y) AS mxy
        FROM pts WHERE isfinite(x) AND isfinite(y) AND isfinite(z)),
grd AS (SELECT mnx, mxx, mny, mxy, (mxx - mnx) / {g} AS sx, (mxy - mny) / {g} AS sy FROM hdr),
asg AS (SELECT p.*, coalesce(isfinite(x) AND isfinite(y) AND isfinite(z), false) AS valid,
               CASE WHEN x BETWEEN mnx AND mxx AND y BETWEEN mny AND mxy
                    THEN {_cell('x', 'mnx', 'sx', g)} * {g} + {_cell('y', 'mny', 'sy', g)} END AS chunk
        FROM {src or 'pts'} p, grd),
ch AS (SELECT *, CAST(chunk // {g} AS VARCHAR) || '_' || CAST(chunk % {g} AS VARCHAR) AS chunk_id FROM asg),
grid AS (SELECT CAST(c AS INTEGER) AS chunk, CAST(c // {g} AS INTEGER) AS i, CAST(c % {g} AS INTEGER) AS j,
                CAST(c // {g} AS VARCHAR) || '_' || CAST(c % {g} AS VARCHAR) AS chunk_id,
                mnx + CAST(c // {g} AS DOUBLE) * sx AS xmin, mnx + CAST(c // {g} + 1 AS DOUBLE) * sx AS xmax,
                mny + CAST(c % {g} AS DOUBLE) * sy AS ymin, mny + CAST(c % {g} + 1 AS DOUBLE) * sy AS ymax
         FROM range({g * g}) t(c), grd)"""


def clean_ctes(view: PointView, src: str = "ch", prefix: str = "", z_min: float | None = None,
               z_max: float | None = None, filter_outliers: bool | None = None) -> str:
    """``{prefix}use`` (valid, placed) -> ``{prefix}kept`` (cleaned) -> ``{prefix}vox`` (voxel rows)."""
    lo = view.z_min if z_min is None else z_min
    hi = view.z_max if z_max is None else z_max
    on = view.filter_outliers if filter_outliers is None else filter_outliers
    s = _f(view.voxel_size)
    p = prefix
    parts = [f"{p}use AS (SELECT chunk, chunk_id, x, y, z FROM {src} WHERE valid AND chunk IS NOT NULL)"]
    if on:
        parts.append(f"{p}rng AS (SELECT * FROM {p}use WHERE z BETWEEN {_f(lo)} AND {_f(hi)})")
        parts.append(f"{p}st AS (SELECT chunk, count(z) AS n_z, avg(z) AS mean_z, stddev_pop(z) AS std_pop_z "
                     f"FROM {p}rng GROUP BY chunk)")
        parts.append(f"{p}kept AS (SELECT r.* FROM {p}rng r JOIN {p}st USING (chunk) "
                     f"WHERE n_z <= 1 OR std_pop_z <= 0.01 OR abs(z - mean_z) <= 3 * std_pop_z)")
    else:
        parts.append(f"{p}kept AS (SELECT * FROM {p}use)")
    parts.append(f"""{p}vox AS (SELECT chunk_id, CAST(floor(x / {s}) AS BIGINT) AS voxel_x,
               CAST(floor(y / {s}) AS BIGINT) AS voxel_y, CAST(floor(z / {s}) AS BIGINT) AS voxel_z,
               count(z) AS point_count, avg(z) AS mean_z, coalesce(stddev_samp(z), 0.0) AS std_z,
               min(z) AS min_z, max(z) AS max_z
        FROM {p}kept GROUP BY chunk_id, voxel_x, voxel_y, voxel_z)""")
    return ",\n".join(parts)


VOX_OUT = (f"chunk_id, voxel_x, voxel_y, voxel_z, point_count, {q6('mean_z')} AS mean_z, "
           f"{q6('std_z')} AS std_z, min_z, max_z")


def voxels_sql(view: PointView) -> str:
    return f"WITH {base_ctes(view)},\n{clean_ctes(view)}\nSELECT {VOX_OUT} FROM vox"


def outcome_ctes(view: PointView, floor: float | None, prefix: str, attempted: str = "grid") -> str:
    """Outcome rows ``{prefix}out`` of one run over the chunks of ``attempted``, whose chunks fail where their
    in-range share lies below ``floor`` times that of all rows; ``{prefix}vox``: the voxel rows it loads."""
    p, zin = prefix, f"valid AND z BETWEEN {_f(view.z_min)} AND {_f(view.z_max)}"
    low = "false" if floor is None else (
        f"coalesce(f.points_read, 0) > 0 AND CAST(f.n_z AS DOUBLE) / f.points_read < {_f(floor)} * (SELECT s FROM {p}whole)")
    return f"""{p}whole AS (SELECT CAST(count(*) FILTER (WHERE {zin}) AS DOUBLE) / count(*) AS s FROM ch),
{p}prof AS (SELECT chunk, count(*) AS points_read, count(*) FILTER (WHERE NOT valid) AS points_rejected,
                count(*) FILTER (WHERE {zin}) AS n_z FROM ch GROUP BY chunk),
{p}bad AS (SELECT a.chunk FROM {attempted} a LEFT JOIN {p}prof f USING (chunk) WHERE {low}),
{p}load AS (SELECT * FROM ch WHERE chunk IN (SELECT chunk FROM {attempted})
          AND chunk NOT IN (SELECT chunk FROM {p}bad)),
{clean_ctes(view, src=f'{p}load', prefix=p)},
{p}vc AS (SELECT chunk_id, count(*) AS voxels, CAST(sum(point_count) AS BIGINT) AS points_kept
        FROM {p}vox GROUP BY chunk_id),
{p}out AS (
  SELECT a.chunk, a.chunk_id, CAST(NULL AS BIGINT) AS expected_points,
         CAST(coalesce(f.points_read, 0) AS BIGINT) AS points_read,
         CAST(coalesce(f.points_rejected, 0) AS BIGINT) AS points_rejected,
         CAST(coalesce(v.points_kept, 0) AS BIGINT) AS points_kept,
         CAST(coalesce(v.voxels, 0) AS BIGINT) AS voxels,
         CASE WHEN b.chunk IS NOT NULL THEN 'failed'
              WHEN coalesce(f.points_read, 0) = 0 THEN 'empty' ELSE 'ok' END AS status,
         CASE WHEN b.chunk IS NOT NULL THEN 'in-range share below the floor' END AS error
  FROM {attempted} a LEFT JOIN {p}prof f USING (chunk)
       LEFT JOIN {p}bad b USING (chunk) LEFT JOIN {p}vc v USING (chunk_id))"""


def resume_ctes(view: PointView, first: float, second: float | None, limit: int | None = None) -> str:
    """Two runs, a full one and a resume of its failed chunks (the first ``limit``); a resume in which all
    chunks fail publishes nothing. ``tbl``: visible voxel rows, ``latest``: the latest outcomes."""
    lim = "" if limit is None else f" LIMIT {limit}"
    return f"""{base_ctes(view)},
{outcome_ctes(view, first, 'a_')},
prev AS (SELECT chunk, chunk_id FROM a_out WHERE status = 'failed'),
att AS (SELECT chunk, chunk_id FROM prev ORDER BY chunk{lim}),
{outcome_ctes(view, second, 'b_', attempted='att')},
pub AS (SELECT * FROM b_out WHERE EXISTS (SELECT 1 FROM b_out WHERE status <> 'failed')),
latest AS (SELECT * FROM a_out WHERE chunk NOT IN (SELECT chunk FROM pub) UNION ALL SELECT * FROM pub),
tbl AS (SELECT 1 AS run_seq, * FROM a_vox UNION ALL SELECT 2, * FROM b_vox)"""


def totals_sql(src: str) -> str:
    return f"""SELECT CAST(sum(CASE WHEN status <> 'failed' THEN points_read ELSE 0 END) AS BIGINT) AS total_points_read,
       CAST(sum(CASE WHEN status <> 'failed' THEN points_kept ELSE 0 END) AS BIGINT) AS total_points_kept,
       CAST(sum(voxels) AS BIGINT) AS total_voxels,
       count(*) FILTER (WHERE status = 'ok') AS chunks_ok,
       count(*) FILTER (WHERE status = 'empty') AS chunks_empty,
       count(*) FILTER (WHERE status = 'failed') AS chunks_failed,
       sum(CASE WHEN status <> 'failed' THEN points_read ELSE 0 END) / nullif(sum(voxels), 0) AS points_per_voxel
FROM {src}"""


OUTCOME_OUT = "chunk_id, expected_points, points_read, points_rejected, points_kept, voxels, status, error"


def oracle_sql() -> dict[str, str]:
    P1, P2, P3 = LINEITEM, EVENTS, EMBED
    v1 = f"WITH {base_ctes(P1)},\n{clean_ctes(P1)}\n"
    q: dict[str, str] = {}

    q["points_bounds"] = f"""WITH pts AS ({points_sql(P1)})
SELECT min(x) FILTER (WHERE isfinite(x) AND isfinite(y) AND isfinite(z)) AS min_x,
       max(x) FILTER (WHERE isfinite(x) AND isfinite(y) AND isfinite(z)) AS max_x,
       min(y) FILTER (WHERE isfinite(x) AND isfinite(y) AND isfinite(z)) AS min_y,
       max(y) FILTER (WHERE isfinite(x) AND isfinite(y) AND isfinite(z)) AS max_y,
       min(z) FILTER (WHERE isfinite(x) AND isfinite(y) AND isfinite(z)) AS min_z,
       max(z) FILTER (WHERE isfinite(x) AND isfinite(y) AND isfinite(z)) AS max_z,
       count(*) AS point_count FROM pts"""

    q["points_in_box"] = f"""WITH pts AS ({points_sql(P2)})
SELECT x, y, z FROM pts WHERE x >= 30.0 AND x <= 90.0 AND y >= 100.0 AND y <= 500.0"""

    q["chunk_occupancy"] = f"""WITH {base_ctes(P1)},
cnt AS (SELECT chunk, count(*) AS n FROM ch WHERE valid AND chunk IS NOT NULL GROUP BY chunk)
SELECT g.chunk_id, g.i, g.j, g.xmin, g.xmax, g.ymin, g.ymax, CAST(coalesce(c.n, 0) AS BIGINT) AS n_points
FROM grid g LEFT JOIN cnt c USING (chunk)"""

    q["elevation_filter"] = f"""WITH {base_ctes(P2)}
SELECT chunk_id, count(*) AS n_points,
       count(*) FILTER (WHERE z BETWEEN {_f(P2.z_min)} AND {_f(P2.z_max)}) AS n_in_range
FROM ch WHERE valid AND chunk IS NOT NULL GROUP BY chunk_id"""

    q["chunk_z_stats"] = f"""WITH {base_ctes(P2)},
rng AS (SELECT * FROM ch WHERE valid AND chunk IS NOT NULL AND z BETWEEN {_f(P2.z_min)} AND {_f(P2.z_max)})
SELECT chunk_id, count(z) AS n_z, {q6('avg(z)')} AS mean_z, {q6('stddev_pop(z)')} AS std_pop_z
FROM rng GROUP BY chunk_id"""

    q["sigma_filter"] = f"""WITH {base_ctes(P2)},
{clean_ctes(P2)}
SELECT chunk_id, count(*) AS n_kept FROM kept GROUP BY chunk_id"""

    s3 = _f(P3.voxel_size)
    q["voxel_index"] = f"""WITH pts AS ({points_sql(P3)})
SELECT vec_id, x, y, z, CAST(floor(x / {s3}) AS BIGINT) AS voxel_x, CAST(floor(y / {s3}) AS BIGINT) AS voxel_y,
       CAST(floor(z / {s3}) AS BIGINT) AS voxel_z FROM pts"""

    q["voxelize_raw"] = voxels_sql(P3)
    q["voxelize_clean"] = voxels_sql(P1)

    narrow = P2.narrow
    q["voxelize_events"] = f"""WITH {base_ctes(P2)},
{clean_ctes(P2, prefix='d_')},
{clean_ctes(P2, prefix='n_', z_min=narrow[0], z_max=narrow[1])}
SELECT 'default' AS z_limits, {VOX_OUT} FROM d_vox
UNION ALL
SELECT 'narrow' AS z_limits, {VOX_OUT} FROM n_vox"""

    q["voxelize_first_chunks"] = f"""WITH {base_ctes(P1)},
first_ch AS (SELECT * FROM ch WHERE chunk IN (SELECT chunk FROM grid ORDER BY chunk LIMIT {P1.first_chunks})),
{clean_ctes(P1, src='first_ch')}
SELECT {VOX_OUT} FROM vox"""

    q["chunk_outcomes"] = f"""WITH {base_ctes(P2)},
{outcome_ctes(P2, SHARE_FLOOR, 'r1_')}
SELECT {OUTCOME_OUT} FROM r1_out"""

    q["ingest_totals"] = f"""WITH {base_ctes(P1)},
{outcome_ctes(P1, None, 'r1_')}
{totals_sql('r1_out')}"""
    q["stored_totals"] = f"WITH {resume_ctes(P2, SHARE_FLOOR, RESUME_FLOOR)}\n{totals_sql('latest')}"
    q["ingest_store"] = voxels_sql(P1)
    q["ingest_twice"] = voxels_sql(replace(P2, voxel_size=2 * P2.voxel_size))
    q["staged_ingest"] = voxels_sql(P2)
    q["staged_damage"] = f"""WITH {base_ctes(P2)},
occ AS (SELECT chunk, count(*) AS n FROM ch WHERE chunk IS NOT NULL GROUP BY chunk),
bad AS (SELECT chunk FROM occ ORDER BY chunk LIMIT 2 OFFSET 1),
load AS (SELECT * FROM ch WHERE chunk IS NOT NULL AND chunk NOT IN (SELECT chunk FROM bad)),
{clean_ctes(P2, src='load')},
vc AS (SELECT chunk_id, count(*) AS voxels, sum(point_count) AS kept FROM vox GROUP BY chunk_id)
SELECT g.chunk_id, o.n AS expected_points, CAST(coalesce(v.kept, 0) AS BIGINT) AS points_kept, CAST(coalesce(v.voxels, 0) AS BIGINT) AS voxels,
       CASE WHEN g.chunk IN (SELECT chunk FROM bad) THEN 'failed' WHEN o.n IS NULL THEN 'empty' ELSE 'ok' END AS status
FROM grid g LEFT JOIN occ o USING (chunk) LEFT JOIN vc v USING (chunk_id)"""
    q["staged_repair"] = voxels_sql(P2)
    stored = (f"WITH run AS (WITH {resume_ctes(P2, SHARE_FLOOR, RESUME_FLOOR)}\nSELECT * EXCLUDE (run_seq) FROM tbl),\n"
              f"more AS (WITH {base_ctes(P3)},\n{clean_ctes(P3)}\nSELECT * REPLACE ('loaded' AS chunk_id) FROM vox),\n"
              "vox AS (SELECT * FROM run UNION ALL SELECT * FROM more)\n")
    q["stored_reads"] = stored + f"""SELECT count(*) AS total_voxels, CAST(sum(point_count) AS BIGINT) AS total_points,
       min(voxel_x) AS x_min, max(voxel_x) AS x_max, min(voxel_y) AS y_min, max(voxel_y) AS y_max, min(voxel_z) AS z_min, max(voxel_z) AS z_max,
       {q6('avg(point_count)')} AS avg_points_per_voxel, min(min_z) AS min_elev, max(max_z) AS max_elev, {q6('avg(mean_z)')} AS avg_elev FROM vox"""
    q["stored_densest"] = stored + f"SELECT {VOX_OUT} FROM vox ORDER BY point_count DESC, voxel_x, voxel_y, voxel_z, chunk_id LIMIT 100"
    q["resume_store"] = f"WITH {resume_ctes(P2, SHARE_FLOOR, RESUME_FLOOR)}\nSELECT {VOX_OUT} FROM tbl"

    q["voxel_stats"] = v1 + """SELECT count(*) AS total_voxels, CAST(sum(point_count) AS BIGINT) AS total_points,
       min(voxel_x) AS x_min, max(voxel_x) AS x_max, min(voxel_y) AS y_min, max(voxel_y) AS y_max,
       min(voxel_z) AS z_min, max(voxel_z) AS z_max FROM vox"""
    q["voxel_summary"] = v1 + f"""SELECT count(*) AS voxel_count, CAST(sum(point_count) AS BIGINT) AS total_points,
       {q6('avg(point_count)')} AS avg_points_per_voxel FROM vox"""
    q["voxel_extents"] = v1 + """SELECT min(voxel_x) AS min_voxel_x, max(voxel_x) AS max_voxel_x,
       min(voxel_y) AS min_voxel_y, max(voxel_y) AS max_voxel_y,
       min(voxel_z) AS min_voxel_z, max(voxel_z) AS max_voxel_z FROM vox"""
    q["elevation_profile"] = v1 + f"""SELECT min(min_z) AS min_elev, max(max_z) AS max_elev,
       {q6('avg(mean_z)')} AS avg_elev FROM vox"""
    q["voxel_row_count"] = v1 + "SELECT count(*) AS row_count FROM vox"

    q["densest_voxels"] = v1 + f"""SELECT voxel_x, voxel_y, voxel_z, point_count, {q6('mean_z')} AS mean_z,
       {q6('std_z')} AS std_z, min_z, max_z, chunk_id
FROM vox ORDER BY point_count DESC, voxel_x, voxel_y, voxel_z, chunk_id LIMIT 10"""
    q["densest_report"] = v1 + f"""SELECT voxel_x, voxel_y, voxel_z, point_count, {r2('mean_z')} AS mean_z,
       {r2('std_z')} AS std_z
FROM vox ORDER BY point_count DESC, voxel_x, voxel_y, voxel_z, chunk_id LIMIT 5"""

    box = P1.box
    s1 = P1.voxel_size
    import math
    fb = {k: math.floor(v / s1) for k, v in box.items()}
    q["voxels_in_box"] = v1 + f"""SELECT {VOX_OUT} FROM vox
WHERE voxel_x >= {fb['min_x']} AND voxel_x <= {fb['max_x']} AND voxel_y >= {fb['min_y']}
  AND voxel_y <= {fb['max_y']} AND voxel_z <= {fb['max_z']}
ORDER BY voxel_x, voxel_y, voxel_z, chunk_id LIMIT {P1.box_limit}"""
    ib = {k: int(v) for k, v in P1.index_box.items()}
    q["voxels_in_box_index"] = v1 + f"""SELECT {VOX_OUT} FROM vox
WHERE voxel_x >= {ib['min_x']} AND voxel_x <= {ib['max_x']} AND voxel_y >= {ib['min_y']}
  AND voxel_y <= {ib['max_y']} AND voxel_z >= {ib['min_z']}
ORDER BY voxel_x, voxel_y, voxel_z, chunk_id LIMIT {P1.box_limit}"""
    bt = P1.between
    q["voxels_between"] = v1 + f"""SELECT {VOX_OUT} FROM vox
WHERE voxel_x BETWEEN {bt[0]} AND {bt[1]} AND voxel_y BETWEEN {bt[2]} AND {bt[3]}"""

    q["stored_box_lookup"] = q["voxels_in_box"]
    v2 = f"WITH v1 AS ({v1}SELECT * FROM vox), v2 AS (WITH {base_ctes(P2)},\n{clean_ctes(P2)}\nSELECT * FROM vox)"
    q["stored_append"] = f"""{v2}
SELECT {VOX_OUT} FROM (SELECT * FROM v1 UNION ALL SELECT * REPLACE ('loaded' AS chunk_id) FROM v2)
WHERE voxel_x >= {fb['min_x']} AND voxel_x <= {fb['max_x']} AND voxel_y >= {fb['min_y']}
  AND voxel_y <= {fb['max_y']} AND voxel_z <= {fb['max_z']}
ORDER BY voxel_x, voxel_y, voxel_z, chunk_id LIMIT {P1.box_limit}"""

    q["resume_points"] = f"WITH {resume_ctes(P2, SHARE_FLOOR, None)}\nSELECT {VOX_OUT} FROM tbl WHERE run_seq = 2"
    # A first run with failed chunks and their recovery must equal the full run: the oracle is the full run.
    q["resume_append"] = voxels_sql(P2)
    q["ledger_after_resume"] = (f"WITH {resume_ctes(P2, SHARE_FLOOR, RESUME_FLOOR, P2.resume_max_chunks)}\n"
                                "SELECT chunk_id FROM latest WHERE status = 'failed'")

    meta = P1.metadata
    rows = ",\n  ".join(f"('{k}', '{v}', {ver})" for k, v, ver in meta)
    q["run_summary"] = v1 + f""", meta_log AS (
  SELECT * FROM (VALUES
  {rows}) t(key, value, version)
  UNION ALL SELECT 'point_count', CAST(count(*) AS VARCHAR), 1 FROM lineitem),
meta AS (SELECT key, arg_max(value, version) AS value FROM meta_log GROUP BY key),
vst AS (SELECT count(*) AS total_voxels, CAST(sum(point_count) AS BIGINT) AS total_points,
       min(voxel_x) AS x_min, max(voxel_x) AS x_max, min(voxel_y) AS y_min, max(voxel_y) AS y_max,
       min(voxel_z) AS z_min, max(voxel_z) AS z_max FROM vox)
SELECT vst.*,
  CAST(coalesce((SELECT value FROM meta WHERE key = 'voxel_size'), '2.0') AS DOUBLE) AS voxel_size_meters,
  CAST(coalesce((SELECT value FROM meta WHERE key = 'grid_size'), '8') AS INTEGER) AS grid_size,
  coalesce((SELECT value FROM meta WHERE key = 'source'), '') AS source,
  CAST(coalesce((SELECT value FROM meta WHERE key = 'point_count'), '0') AS BIGINT) AS original_point_count,
  coalesce((SELECT value FROM meta WHERE key = 'filter_outliers'), 'True') = 'True' AS outliers_filtered,
  CAST(json_array_length(coalesce((SELECT value FROM meta WHERE key = 'failed_chunks'), '[]')) AS INTEGER)
    AS failed_chunk_count,
  CAST(json(coalesce((SELECT value FROM meta WHERE key = 'failed_chunks'), '[]')) AS VARCHAR) AS failed_chunks
FROM vst"""

    q["layout_roundtrip"] = voxels_sql(P1)
    return q
