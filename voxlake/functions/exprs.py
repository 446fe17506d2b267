"""Scalar building blocks (S8.*). Everything returns a JVM-side Column, so plans stay in codegen.

Expressions over named columns are written as SQL expression strings (one ``F.expr`` call
each): building them with chained ``F.col`` / operator calls costs a py4j round trip per
node, which dominated plan construction for small inputs. Double literals carry the ``D``
suffix, so they are doubles in the plan (a bare ``0.1`` would be a DECIMAL).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dlit(v: float) -> str:
    """A finite double as a Spark SQL double literal (round-trips exactly)."""
    v = float(v)
    if not math.isfinite(v):
        raise ValueError(f"literal must be finite, got {v}")
    return f"{v!r}D"


def _name(c: str) -> str:
    return f"`{c}`"


def round_half_away(c: str, digits: int) -> Column:
    """Round to ``digits`` decimals, halves away from zero, by plain double arithmetic.

    ``F.round`` rounds the decimal form (1.005 -> 1.01) while the reference's engine rounds
    the binary product (1.005 -> 1.0); ``sign(v) * floor(abs(v) * 10^d + 0.5) / 10^d``
    reproduces the latter bit for bit.
    """
    n, scale = _name(c), dlit(10.0 ** digits)
    return F.expr(f"signum({n}) * floor(abs({n}) * {scale} + 0.5D) / {scale}")


# Compare-grid of :func:`quantize`: multiples of 2^-16 (about 1.5e-5).
QUANTUM_BITS = 16


def quantize(c: str, bits: int = QUANTUM_BITS) -> Column:
    """Round to the nearest multiple of ``2^-bits`` for comparing float aggregates across engines.

    Scaling by a power of two, adding 0.5 and flooring are exact in binary floating point,
    so two engines whose sums differ only in the last bits give the same result unless the
    value sits within those bits of a boundary. A decimal grid (e.g. 1e-6) would not do:
    means of decimal data land exactly on decimal ties, where last-bit noise decides.
    """
    scale = dlit(2.0 ** bits)
    return F.expr(f"floor({_name(c)} * {scale} + 0.5D) / {scale}")


def floor_bound(value: float | None, size: float) -> int | None:
    """Physical bound -> voxel index bound by floor (S2.8, R12); computed once on the driver."""
    if value is None:
        return None
    return int(math.floor(float(value) / float(size)))


def trunc_index(value: float | None) -> int | None:
    """Raw index bound truncated toward zero (S2.9, R13): -1.5 -> -1."""
    if value is None:
        return None
    return int(float(value))


# Spreading 21 bits so that two free ones follow each: shift and mask of each step (the usual bit masks).
SPREAD_STEPS = [(32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)]
CURVE_BITS = 21


def with_curve(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: the place of three integer columns on a Z-order curve.

    Each index keeps its lowest 21 bits, counted from -2^20, so the curve repeats every 2,097,152 voxels: a
    table wider than that keeps its order but for a seam. Each step is a column of its own, as a nested
    expression would double at each.
    """
    parts = [f"{name}_{i}" for i in range(3)]
    df = df.withColumns({p: F.expr(f"({c} + {1 << (CURVE_BITS - 1)}L) & {(1 << CURVE_BITS) - 1}L") for p, c in zip(parts, columns)})
    for shift, mask in SPREAD_STEPS:
        df = df.withColumns({p: F.expr(f"({p} | shiftleft({p}, {shift})) & {mask}L") for p in parts})
    return df.withColumn(name, F.expr(f"{parts[0]} | shiftleft({parts[1]}, 1) | shiftleft({parts[2]}, 2)")).drop(*parts)
