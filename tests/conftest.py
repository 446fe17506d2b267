import os
import sys
import tempfile

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from voxlake.schemas import POINT_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]")
         .appName("voxlake-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # Tests own their checkpoint folder (a cluster names a shared one in spark.checkpoint.dir).
    if s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="voxlake-test-ckpt-"))
    yield s
    s.stop()


def make_points(spark, xs, ys, zs, extra: dict | None = None):
    """Points DataFrame from Python sequences (None allowed)."""
    cols = [xs, ys, zs] + list((extra or {}).values())
    rows = [tuple(None if v is None else (float(v) if i < 3 else v) for i, v in enumerate(r))
            for r in zip(*cols)]
    if extra:
        schema = "x double, y double, z double, " + ", ".join(f"{k} long" for k in extra)
        return spark.createDataFrame(rows, schema)
    return spark.createDataFrame(rows, POINT_SCHEMA)


@pytest.fixture
def sample_cloud():
    """An own cloud in the form of F3: a tilted plane with small noise, two points outside the absolute
    limits and one far from the plane's spread."""
    rng = np.random.default_rng(2024)
    x, y = rng.uniform(400.0, 480.0, 150), rng.uniform(-30.0, 50.0, 150)
    z = 20.0 + 0.02 * (x - 440.0) + rng.normal(0.0, 0.4, 150)
    return np.append(x, [441.0] * 3), np.append(y, [3.0] * 3), np.append(z, [-72.5, 163.0, 34.0])


@pytest.fixture
def store_root(tmp_path):
    return str(tmp_path / "store")


def plan_text(df) -> str:
    """Full ``explain('formatted')`` text (metadata such as PushedFilters not abbreviated)."""
    import contextlib
    import io
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        return buf.getvalue()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
