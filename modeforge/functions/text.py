"""Small helpers for writing SQL expression text.

Building an expression tree node by node over the Python gateway costs far more
than letting Spark parse one string, so the wide, generated expressions of this
package are written as text.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence


def quoted(name: str) -> str:
    """Column name as a quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def number(value: float) -> str:
    """Double literal that reads back to exactly ``value``."""
    value = float(value)
    if not math.isfinite(value):
        raise ValueError(f"not a finite number: {value}")
    return f"({value!r}D)" if value < 0 else f"{value!r}D"


def string(value: str) -> str:
    """String literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def total(terms: Iterable[str]) -> str:
    return "(" + " + ".join(terms) + ")"


def largest(terms: Sequence[str]) -> str:
    return terms[0] if len(terms) == 1 else "greatest(" + ", ".join(terms) + ")"


def pick(selector: str, values: Sequence[str]) -> str:
    """``values[selector]`` for a selector holding 0 .. len-1; null otherwise."""
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {selector} {whens} END"


def first_largest(terms: Sequence[str], best: str) -> str:
    """Position of the first term equal to ``best``."""
    whens = " ".join(f"WHEN {t} = {best} THEN {i}" for i, t in enumerate(terms))
    return f"CASE {whens} END"
