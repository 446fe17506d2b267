"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.session import checkpoint_root, scratch_path

WORD_SPLIT = r"[\x20\x09-\x0D]+"      # runs of ASCII white space
WORD_STRIP = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the checkpoint folder and read it back: cuts lineage, fixes its size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused_gone(spark: SparkSession) -> None:
    """Shuffle files behind tables that have been written and reread go when the driver collects its garbage, which a
    large heap puts off until after the query; ask for it."""
    spark._jvm.System.gc()


def shared_root(spark: SparkSession) -> str:
    return checkpoint_root(spark)


def sql_str(value: str) -> str:
    """A Python string as a SQL string literal (plain and raw-safe)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lower_az(col):
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def python_ready(spark: SparkSession) -> None:
    """Before an operator runs Python in tasks: bound Arrow batches and ship this package.

    A batch holds at most 4 MB, so that a worker's memory does not follow text length. The package
    goes to the executors as a zip through ``addPyFile``, once per application, as they need not have
    it on their path.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    sc = spark.sparkContext
    if _SHIPPED.get("to") != sc.applicationId:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="voxlake-code-"), "voxlake.zip")
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(target))
        _SHIPPED["to"] = sc.applicationId


_SHIPPED: dict[str, str] = {}
