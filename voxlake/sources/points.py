"""Point sources (S1.1-S1.3 re-aimed): any Spark table projected to ``x, y, z`` doubles.

The reference decodes one remote point-cloud file; here points come from any columnar
source with a declared schema. The three views below project the given test tables onto
points with fixed formulas, so that the DuckDB oracle can repeat them exactly.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the point views: origins and scales of the projections.
LINEITEM_Y_ORIGIN = "1995-01-01"          # y = days since this date
EVENTS_Y_ORIGIN = "2024-01-01 00:00:00"   # y = hours since this instant
EMBEDDING_SCALE = 100.0                   # x, y, z = 100 * elements 1, 2, 3


# Declared input columns of each view (types as stored): no schema inference when a query is
# built, and only these columns can ever be read.
VIEW_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_extendedprice DOUBLE, l_discount DOUBLE, "
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, value DOUBLE",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>",
}


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def points_from(df: DataFrame, x: Column | str, y: Column | str, z: Column | str,
                keep: list[str] | None = None) -> DataFrame:
    """Project any DataFrame to the point schema; ``keep`` passes extra columns through."""
    cols = [F.col(c) for c in (keep or [])]
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(*cols,
                     as_col(x).cast("double").alias("x"),
                     as_col(y).cast("double").alias("y"),
                     as_col(z).cast("double").alias("z"))


def read_points(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
                x: str = "x", y: str = "y", z: str = "z", keep: list[str] | None = None,
                **options) -> DataFrame:
    """Points from files of any Spark format; only the coordinate columns are read."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return points_from(reader.load(path), x, y, z, keep)


def lineitem_points(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """x = part key, y = days since 1995-01-01 of the ship date, z = price * discount / 50 - 52."""
    return read_table(spark, sf_dir, "lineitem", VIEW_SCHEMAS["lineitem"]).selectExpr(
        *(keep or []),
        "CAST(l_partkey AS DOUBLE) AS x",
        f"CAST(datediff(CAST(l_shipdate AS DATE), DATE'{LINEITEM_Y_ORIGIN}') AS DOUBLE) AS y",
        "l_extendedprice * l_discount / 50 - 52 AS z",
    )


def events_points(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """x = user id, y = hours since 2024-01-01 (time-zone free on TIMESTAMP_NTZ), z = value / 2 - 52."""
    return read_table(spark, sf_dir, "events", VIEW_SCHEMAS["events"]).selectExpr(
        *(keep or []),
        "CAST(user_id AS DOUBLE) AS x",
        f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{EVENTS_Y_ORIGIN}', ts) / 3.6e9D AS y",
        "value * 0.5D - 52 AS z",
    )


def embedding_points(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """100 x the first three embedding elements (values straddle zero: negative floors)."""
    s = f"{EMBEDDING_SCALE!r}D"
    return read_table(spark, sf_dir, "embeddings", VIEW_SCHEMAS["embeddings"]).selectExpr(
        *(keep or []),
        f"{s} * CAST(embedding[0] AS DOUBLE) AS x",
        f"{s} * CAST(embedding[1] AS DOUBLE) AS y",
        f"{s} * CAST(embedding[2] AS DOUBLE) AS z",
    )


STAGED_SCHEMA = "x DOUBLE, y DOUBLE, z DOUBLE, chunk INT"
HEADER_SCHEMA = ("min_x DOUBLE, max_x DOUBLE, min_y DOUBLE, max_y DOUBLE, min_z DOUBLE, max_z DOUBLE, "
                 "point_count BIGINT, grid_size INT")
FILES_SCHEMA = "chunk INT, file STRING, rows BIGINT, content BIGINT"
# Order-free sum over the values of a set of rows; 28 bits each, so 3 * 10^10 rows fit. NULL and NaN count as themselves.
CONTENT_SQL = "CAST(coalesce(sum(xxhash64(x, y, z) & 268435455), 0) AS BIGINT)"


class StagedPoints:
    """Points stored by chunk: folders ``chunk=<ordinal>``, files sorted by x, y, header and file list beside them.

    A read of some chunks opens only their folders, and x, y ranges skip row groups. Points that no
    chunk holds (NULL or non-finite coordinates, outside the header) lie in the NULL folder, so the
    staged table has every row of its source.

    ``files`` lists each file with its rows and a content sum as they were when it was staged. A later
    read is held against that list, so that a lost, cut, unreadable or changed file is seen, and only its
    chunk fails (S11.1).
    """

    def __init__(self, spark: SparkSession, path: str):
        from voxlake.operators.chunks import Bounds, Grid
        self.spark, self.path = spark, path
        row = spark.read.schema(HEADER_SCHEMA).parquet(os.path.join(path, "header")).first()
        if row is None:
            raise FileNotFoundError(f"no staged points at {path}")
        h = row.asDict()
        self.grid = Grid(Bounds(**{k: v for k, v in h.items() if k != "grid_size"}), h["grid_size"])

    def points(self, tolerant: bool = False) -> DataFrame:
        """The staged rows. ``tolerant``: files that are lost or cannot be read give no rows instead of an error; only
        for reads that are held against :meth:`files`, with the column ``file`` for that."""
        reader = self.spark.read.schema(STAGED_SCHEMA)
        where = os.path.join(self.path, "points")
        if not tolerant:
            return reader.parquet(where)
        lax = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").parquet(where)
        return lax.select("*", F.col("_metadata.file_name").alias("file"))

    def files(self) -> DataFrame:
        """``chunk, file, rows, content`` of every file as staged."""
        return self.spark.read.schema(FILES_SCHEMA).parquet(os.path.join(self.path, "files"))

    def manifest(self) -> DataFrame:
        """Expected rows per chunk as staged, ``(chunk_id, expected_points)``; reads no point."""
        return (self.files().where("chunk IS NOT NULL").groupBy(self.grid.chunk_id("chunk").alias("chunk_id"))
                .agg(F.sum("rows").alias("expected_points")))

    def in_box(self, min_x: float | None = None, max_x: float | None = None,
               min_y: float | None = None, max_y: float | None = None) -> DataFrame:
        """Points of an inclusive box; the folders it cannot touch are pruned (S1.2).

        Points outside every chunk have no place in the pruned folders, so they are looked for in the
        NULL folder as well.
        """
        from voxlake.operators.chunks import points_in_box
        reach = self.grid.reach_sql(min_x, max_x, min_y, max_y)
        return points_in_box(self.points().where(f"chunk IS NULL OR ({reach})"), min_x, max_x, min_y, max_y)


def write_points(points: DataFrame, path: str, grid) -> StagedPoints:
    """Stage ``points`` by the chunks of ``grid`` (rows outside it included).

    ``REBALANCE(chunk)`` sizes the writer tasks and splits a chunk with a large share of the points. The file
    list is taken from the files just written and compared, chunk by chunk, with rows and content sums of the
    source, so a source that changes between the two reads, or a write that loses rows, raises. The header is
    written last: without it there are no staged points.
    """
    from voxlake.sources.values import values_frame
    spark = points.sparkSession
    assigned = grid.assign(points.select("x", "y", "z"))
    where = os.path.join(path, "points")
    (assigned.hint("rebalance", "chunk").sortWithinPartitions("chunk", "x", "y").write.mode("overwrite")
     .option("maxRecordsPerFile", 4_000_000).partitionBy("chunk").parquet(where))
    back = spark.read.schema(STAGED_SCHEMA).parquet(where).select("*", F.col("_metadata.file_name").alias("file"))
    (back.groupBy("chunk", "file").agg(F.expr("count(1) AS rows"), F.expr(f"{CONTENT_SQL} AS content"))
     .write.mode("overwrite").parquet(os.path.join(path, "files")))
    listed = (spark.read.schema(FILES_SCHEMA).parquet(os.path.join(path, "files")).groupBy("chunk")
              .agg(F.expr("sum(rows) AS rows"), F.expr("sum(content) AS content")))
    source = assigned.groupBy("chunk").agg(F.expr("count(1) AS rows"), F.expr(f"{CONTENT_SQL} AS content"))
    differ = source.exceptAll(listed).unionByName(listed.exceptAll(source)).agg(F.expr("array_sort(collect_set(chunk)) AS bad"),
                                                                               F.count("*").alias("n")).first()
    if differ["n"]:
        raise RuntimeError(f"staged points at {path} differ from their source in chunks {differ['bad']}")
    b = grid.bounds
    names = [f.split()[0] for f in HEADER_SCHEMA.split(", ")]
    kinds = [f.split()[1] for f in HEADER_SCHEMA.split(", ")]
    row = (b.min_x, b.max_x, b.min_y, b.max_y, b.min_z, b.max_z, b.point_count, grid.size)
    values_frame(spark, names, kinds, [row]).write.mode("overwrite").parquet(os.path.join(path, "header"))
    return StagedPoints(spark, path)
