"""Expressions of a fitted mixture: densities, mode draw, normalisation, inverse.

A *stage* is a list of ``(name, expression)`` pairs added by one projection.
Later stages refer to earlier names, so each exponential is written and
evaluated once; ``apply_stages`` lays the stages of many columns side by side.
All of it is narrow: no shuffle, no Python on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from modeforge.functions.text import largest, number, quoted, total

# Fixed value: added to every active probability before the draw.
SMOOTHING = 1e-6

# Components whose stages still fit into one compiled method, and terms that are
# summed together where there are more.
FUSED_COMPONENTS, _BLOCK = 16, 8

Stage = list[tuple[str, str]]


def is_finite(x: str) -> str:
    """Whether the value is neither NaN nor infinite; null for null."""
    return f"abs(CAST({x} AS DOUBLE)) < double('Infinity')"


def finite(x: str) -> str:
    """The value as a double, null where it is null, NaN or infinite."""
    return f"CASE WHEN {is_finite(x)} THEN CAST({x} AS DOUBLE) END"


def log_density(x: str, const: float, half_precision: float, mean: float) -> str:
    """Expected log density of one component, up to a term shared by all."""
    d = f"({x} - {number(mean)})"
    return f"({number(const)} - {number(half_precision)} * {d} * {d})"


def responsibility_stages(
    x: str,
    consts: Sequence[float],
    half_precisions: Sequence[float],
    means: Sequence[float],
    p: str,
) -> list[Stage]:
    """``{p}ok`` whether there is a value, ``{p}x`` that value (0 if there is
    none), ``{p}l*`` log densities, ``{p}e*`` scaled densities, ``{p}t`` their sum.

    The responsibility of component k is ``{p}e{k} / {p}t``.  Nothing after the
    first stage can be null: null checks would be most of the generated code.
    """
    ks = range(len(means))
    there = f"coalesce({is_finite(x)}, false)"
    return [
        [
            (f"{p}ok", there),
            (f"{p}x", f"CASE WHEN {there} THEN coalesce(CAST({x} AS DOUBLE), 0.0D) ELSE 0.0D END"),
        ],
        [
            (f"{p}l{k}", log_density(f"{p}x", consts[k], half_precisions[k], means[k]))
            for k in ks
        ],
        [(f"{p}m", largest([f"{p}l{k}" for k in ks]))],
        [(f"{p}e{k}", f"exp({p}l{k} - {p}m)") for k in ks],
        [(f"{p}t", total(f"{p}e{k}" for k in ks))],
    ]


def draw_stages(active: Sequence[int], u: str, p: str) -> list[Stage]:
    """``{p}z``: position (among the active) drawn by inverse distribution; the
    number of active components where there is no value.

    The smoothed probabilities ``{p}q*`` are left multiplied by ``{p}t``, and
    their running sums are compared with ``u`` times the last one: no division.
    """
    last = len(active) - 1
    before, sums = _running_sums([f"{p}q{k}" for k in active], p)
    whens = " ".join(f"WHEN {p}u < {p}c{i} THEN {i}" for i in range(last))
    return [
        [(f"{p}q{k}", f"{p}e{k} + {number(SMOOTHING)} * {p}t") for k in active],
        *before,
        [
            *((f"{p}c{i}", sums[i]) for i in range(last)),
            (f"{p}u", f"{u} * {sums[last]}"),
        ],
        [(f"{p}z", f"CASE WHEN NOT {p}ok THEN {last + 1} {whens} ELSE {last} END")],
    ]


def _running_sums(terms: Sequence[str], p: str) -> tuple[list[Stage], list[str]]:
    """Stages to add first, and the running sums of the terms.

    Many terms are summed in blocks, so that the text grows with their number
    and not with its square.
    """
    if len(terms) <= FUSED_COMPONENTS:
        return [], [total(terms[: i + 1]) for i in range(len(terms))]
    blocks = [terms[i : i + _BLOCK] for i in range(0, len(terms), _BLOCK)]
    sums = []
    for j, block in enumerate(blocks):
        start = [f"{p}s{j}"] if j else []
        sums += [total([*start, *block[: i + 1]]) for i in range(len(block))]
    return [
        [(f"{p}b{j}", total(block)) for j, block in enumerate(blocks[:-1])],
        [
            (f"{p}s{j}", total(f"{p}b{i}" for i in range(j)))
            for j in range(1, len(blocks))
        ],
    ], sums


def lookup(z: str, values: Sequence[str]) -> str:
    """``values[z]`` for a ``z`` that is never null; the constant values become
    one array that all rows share."""
    return f"array({', '.join(values)})[{z}]"


def lookup_or_null(z: str, values: Sequence[str]) -> str:
    """``values[z]``, null for a null ``z``."""
    return f"get(array({', '.join(values)}), {z})"


def scaled_within(
    x: str, z: str, means: Sequence[float], spreads: Sequence[float], factor: float
) -> str:
    """Distance from the mean of mode ``z`` in units of ``factor`` spreads.

    Where there is no mode the result is 0.
    """
    centre = lookup(z, [*(number(m) for m in means), "0.0D"])
    inverse = lookup(z, [*(number(1.0 / (factor * s)) for s in spreads), "0.0D"])
    return f"(({x} - {centre}) * {inverse})"


def clipped(value: str, low: float, high: float) -> str:
    """Value limited to [low, high]; null stays null."""
    low, high = number(low), number(high)
    return f"CASE WHEN {value} < {low} THEN {low} WHEN {value} > {high} THEN {high} ELSE {value} END"


def unscaled(
    n: str, z: str, means: Sequence[float], spreads: Sequence[float], factor: float
) -> str:
    """Inverse of ``scaled_within``."""
    centre = lookup_or_null(z, [number(m) for m in means])
    width = lookup_or_null(z, [number(factor * s) for s in spreads])
    return f"({n} * {width} + {centre})"


def indicator(condition: str) -> str:
    """1.0 where the condition holds, else 0.0 (also where it is unknown)."""
    return f"CASE WHEN {condition} THEN 1.0D ELSE 0.0D END"


def fenced(df: DataFrame, keep: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Columns ``keep``, and ``names`` as the optimizer will no longer expand them.

    A filter on a column moves below the projection that defines it, with the
    definition in place of the name.  Through stages that each mention several
    earlier names this would multiply into expressions of millions of nodes.  A
    generator of one row per row stops that, while filters on the kept columns
    still move through it down to the scan.
    """
    pairs = ", ".join(f"'{n}', {n}" for n in names)
    return df.selectExpr(*keep, f"inline(array(named_struct({pairs})))")


def apart(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions, but compiled apart from what follows.

    Spark fuses consecutive projections into one method, and past 8000 bytes
    the JVM only interprets that, some twenty times slower.  Joining partitions
    up to a number that none reaches moves nothing and ends the fusion.
    """
    return df.coalesce(_NEVER_REACHED)


_NEVER_REACHED = 1 << 24


def apply_stages(df: DataFrame, groups: Sequence[Sequence[Stage]]) -> DataFrame:
    """Add the stages of every group, stage by stage, to all columns of ``df``."""
    depth = max((len(g) for g in groups), default=0)
    for level in range(depth):
        added = [
            f"{text} AS {quoted(name)}"
            for group in groups
            if level < len(group)
            for name, text in group[level]
        ]
        if added:
            df = df.selectExpr("*", *added)
        if len(added) > FUSED_COMPONENTS:
            df = apart(df)
    return df
