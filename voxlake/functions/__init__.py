"""Column expressions shared by the operators (all native Spark expressions)."""

from voxlake.functions.exprs import dlit, floor_bound, quantize, round_half_away, trunc_index

__all__ = ["dlit", "floor_bound", "quantize", "round_half_away", "trunc_index"]
