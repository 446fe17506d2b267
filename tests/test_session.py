"""Scratch folders for lineage cuts live under the session's checkpoint folder."""

from voxlake.session import checkpoint_root, scratch_path


def test_scratch_under_checkpoint_root(spark):
    sc = spark.sparkContext
    root = checkpoint_root(spark)
    named = sc.getConf().get("spark.checkpoint.dir", None)
    # a folder named by the cluster wins; otherwise the one set on the context (tests set their own)
    assert root == (named or sc.getCheckpointDir())
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)
    assert sc.getCheckpointDir() is not None
