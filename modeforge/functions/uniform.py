"""Uniform numbers in (0, 1) that follow the row, not the partition.

A draw keyed on the row gives the same answer when a task is retried, when the
data is repartitioned and when a plan is evaluated twice.  Every purpose and
seed is mixed into the key, so draws for jitter, sampling and modes are
independent of one another.
"""

from __future__ import annotations

from collections.abc import Sequence

from modeforge.functions.text import quoted, string


def keyed_uniform(
    keys: Sequence[str] | None,
    seed: int,
    purpose: str,
    portable: bool = False,
) -> str:
    """SQL text of a uniform draw.

    ``keys`` are SQL expressions that identify the row (see ``key_columns``).
    Without keys the draw is ``rand(seed)``, which depends on how the input is
    split into partitions.  ``portable`` swaps the fast 64-bit hash for an md5
    form that other SQL engines can reproduce.
    """
    if not keys:
        # xxhash64 of the purpose keeps equally seeded draws apart.
        return f"rand({_mix(seed, purpose)})"
    if portable:
        parts = ", ".join([string(f"{purpose}:{seed}"), *(f"CAST({k} AS STRING)" for k in keys)])
        digits = f"substr(md5(concat_ws('|', {parts})), 1, 8)"
        return f"((CAST(conv({digits}, 16, 10) AS DOUBLE) + 0.5D) / 4294967296.0D)"
    # 52 bits plus a half: exact in a double, never 0 and never 1.
    hashed = f"xxhash64({string(f'{purpose}:{seed}')}, {', '.join(keys)})"
    return f"((shiftrightunsigned({hashed}, 12) + 0.5D) / 4503599627370496.0D)"


def key_columns(key: str | Sequence[str] | None) -> list[str]:
    """Key given as a name or names, as SQL expressions."""
    if key is None:
        return []
    return [quoted(k) for k in ([key] if isinstance(key, str) else key)]


def _mix(seed: int, purpose: str) -> int:
    value = seed & 0x7FFFFFFF
    for byte in purpose.encode():
        value = (value * 131 + byte) & 0x7FFFFFFF
    return value
