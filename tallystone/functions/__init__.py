"""Expressions that Catalyst does not turn into scan filters by itself."""

from .keyset import seek_after
from .truncation import aligned_range, ceil_time, floor_time, step, trunc_cmp, trunc_text

__all__ = ["aligned_range", "ceil_time", "floor_time", "seek_after", "step", "trunc_cmp", "trunc_text"]
