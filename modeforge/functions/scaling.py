"""Min-max scaling to [-1, 1]."""

from __future__ import annotations

from modeforge.functions.mixture import clipped
from modeforge.functions.text import number


def to_min_max(x: str, low: float, high: float) -> str:
    """The value rescaled and limited to [-1, 1]; 0 for a constant column."""
    if high == low:
        return f"CASE WHEN {x} IS NOT NULL THEN 0.0D END"
    scaled = f"(({x} - {number(low)}) / {number(high - low)} * 2.0D - 1.0D)"
    return clipped(scaled, -1.0, 1.0)


def from_min_max(n: str, low: float, high: float) -> str:
    """Inverse of ``to_min_max``."""
    return f"(({n} + 1.0D) / 2.0D * {number(high - low)} + {number(low)})"
