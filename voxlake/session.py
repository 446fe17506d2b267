"""Session helpers: a local session for tests and the shared scratch folder for lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "voxlake") -> SparkSession:
    """Local-mode session with AQE on and the UI off (tests, bench)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent and the master is local (tests, bench) do we create a
    folder of our own; on a cluster a machine-local folder would not survive executor loss,
    so we refuse instead.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or _LOCAL_ROOTS.get(id(sc))
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
        root = tempfile.mkdtemp(prefix="voxlake-ckpt-")
        _LOCAL_ROOTS[id(sc)] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


_LOCAL_ROOTS: dict[int, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one written intermediate table."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that is no longer read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_file(spark: SparkSession, path: str, share: float) -> None:
    """Keep the first ``share`` of a file's bytes, or remove it for 0: what a failed disk or transfer leaves."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    if share > 0:
        rest = jvm.org.apache.hadoop.fs.Path(path + ".cut")
        source, target = fs.open(at), fs.create(rest)
        jvm.org.apache.commons.io.IOUtils.copyLarge(source, target, 0, int(fs.getFileStatus(at).getLen() * share))
        source.close()
        target.close()
    fs.delete(at, False)
    if share > 0:
        fs.rename(rest, at)
