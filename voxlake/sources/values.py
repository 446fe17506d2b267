"""Small literal tables built on the JVM side.

``spark.createDataFrame(list_of_rows)`` ships pickled rows and starts a Python worker on
the executor to read them -- a fixed cost of several hundred milliseconds for a handful of
rows. Metadata rows and chunk-id lists are tiny and bounded, so they are written as one SQL
``stack(...)`` expression instead: one py4j call, no Python worker.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession


def sql_literal(v) -> str:
    """A Python scalar as a Spark SQL literal (strings escaped, doubles exact)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return f"{v}L"
    if isinstance(v, float):
        if not math.isfinite(v):
            raise ValueError(f"non-finite literal {v}")
        return f"{v!r}D"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def values_frame(spark: SparkSession, columns: list[str], types: list[str], rows: list[tuple]) -> DataFrame:
    """A DataFrame of ``rows`` with the given column names and SQL types (e.g. ``"string"``)."""
    casts = [f"CAST({c} AS {t}) AS {c}" for c, t in zip(columns, types)]
    if not rows:
        return spark.range(0).selectExpr(*[f"CAST(NULL AS {t}) AS {c}" for c, t in zip(columns, types)])
    args = ", ".join(sql_literal(v) for row in rows for v in row)
    stacked = f"stack({len(rows)}, {args}) AS ({', '.join(columns)})"
    return spark.range(1).selectExpr(stacked).selectExpr(*casts)


def empty_frame(spark: SparkSession, schema) -> DataFrame:
    """An empty DataFrame with the given ``StructType``, built without Python rows."""
    return values_frame(spark, schema.fieldNames(), [f.dataType.simpleString() for f in schema.fields], [])
