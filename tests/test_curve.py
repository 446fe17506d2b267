"""S1.11: the stored order skips row groups for bounds in every direction."""

import glob
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from voxlake.functions.exprs import with_curve
from voxlake.schemas import INDEX_COLUMNS, VOXEL_COLUMNS
from voxlake.sources.store import read_voxel_layout, write_voxel_layout

SIDE = 32


def test_curve_interleaves_the_bits(spark):
    rng = random.Random(3)
    rows = [tuple(rng.choice([rng.randint(-(1 << 20), (1 << 20) - 1), rng.randint(-3, 3)]) for _ in range(3)) for _ in range(200)]

    def place(row):
        return sum(((v + (1 << 20)) >> bit & 1) << (3 * bit + axis) for axis, v in enumerate(row) for bit in range(21))
    got = with_curve(spark.createDataFrame(rows, "voxel_x long, voxel_y long, voxel_z long"), INDEX_COLUMNS, "c").collect()
    assert [r.c for r in got] == [place(r) for r in rows]
    # Beyond 2^20 the curve begins anew, without an error.
    far = spark.createDataFrame([(1 << 40, -(1 << 62), 5), ((1 << 63) - 1 - (1 << 20), -(1 << 63), 5)], "voxel_x long, voxel_y long, voxel_z long")
    assert all(r.c >= 0 for r in with_curve(far, INDEX_COLUMNS, "c").collect())


@pytest.fixture(scope="module")
def layouts(spark, tmp_path_factory):
    """A cube of voxels in one chunk, in both orders, in small row groups."""
    n = SIDE ** 3
    cube = spark.range(n).selectExpr(f"id DIV {SIDE * SIDE} - 5 AS voxel_x", f"id DIV {SIDE} % {SIDE} - 9 AS voxel_y", f"id % {SIDE} AS voxel_z", "id + 1 AS point_count",
                                     "rand(1) AS mean_z", "rand(2) AS std_z", "rand(3) AS min_z", "rand(4) AS max_z", "'0_0' AS chunk_id")
    out = {}
    for order in ("index", "curve"):
        out[order] = str(tmp_path_factory.mktemp("layout") / order)
        write_voxel_layout(cube, out[order], order=order, row_group_bytes=1 << 16)
    return out


def opened(path, axis, lo, hi):
    """Row groups whose statistics do not rule the range out, and all of them."""
    hit = every = 0
    for f in glob.glob(os.path.join(path, "chunk_id=*", "*.parquet")):
        meta = pq.ParquetFile(f).metadata
        names = meta.schema.names
        for g in range(meta.num_row_groups):
            st = meta.row_group(g).column(names.index(axis)).statistics
            hit += st.min <= hi and st.max >= lo
            every += 1
    return hit, every


def test_thin_boxes_open_fewer_row_groups(layouts):
    for axis, at in (("voxel_y", 3), ("voxel_z", 20)):
        (linear, every), (curve, of) = (opened(layouts[o], axis, at, at) for o in ("index", "curve"))
        assert every >= 15 and of >= 15
        assert linear >= 0.9 * every        # a row group of the linear order holds whole slabs of x
        assert curve <= 0.6 * linear
    curve, of = opened(layouts["curve"], "voxel_x", 3, 3)
    assert curve <= 0.6 * of


def test_orders_hold_the_same_rows_and_skip_in_the_scan(spark, layouts):
    index, curve = (read_voxel_layout(spark, layouts[o]) for o in ("index", "curve"))
    assert index.count() == SIDE ** 3 and index.exceptAll(curve).isEmpty()
    box = "voxel_y BETWEEN 3 AND 4 AND voxel_z BETWEEN 8 AND 9"
    assert sorted(map(tuple, index.where(box).select(*VOXEL_COLUMNS).collect())) == sorted(map(tuple, curve.where(box).select(*VOXEL_COLUMNS).collect()))
    first = curve.select("voxel_x").first()[0]
    assert curve.agg(F.min("voxel_x")).first()[0] == first == -5
    with pytest.raises(ValueError):
        write_voxel_layout(index, layouts["index"] + "-x", order="other")
