"""Per-row scores of a mixture, and its sufficient statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeforge.functions import mixture as mx
from modeforge.functions.text import first_largest, quoted
from modeforge.operators.model import Mixture

_P = "__s_"


def _scored(df: DataFrame, column: str, m: Mixture) -> DataFrame:
    stages = mx.responsibility_stages(quoted(column), m.consts, m.half_precisions, m.means, _P)
    return mx.apply_stages(df, [stages])


def _input(df: DataFrame) -> list[str]:
    return [quoted(c) for c in df.columns]


def responsibilities(df: DataFrame, column: str, m: Mixture) -> DataFrame:
    """Add ``r0 ... r{K-1}``: shares of all components; null without a value."""
    shares = [f"CASE WHEN {_P}ok THEN {_P}e{k} / {_P}t END AS r{k}" for k in range(m.size)]
    return _scored(df, column, m).selectExpr(*_input(df), *shares)


def hard_assignment(df: DataFrame, column: str, m: Mixture) -> DataFrame:
    """Add ``component``: the likeliest of all components, the first on a tie."""
    logs = [f"{_P}l{k}" for k in range(m.size)]
    best = f"CASE WHEN {_P}ok THEN {first_largest(logs, f'{_P}m')} END AS component"
    return _scored(df, column, m).selectExpr(*_input(df), best)


def smoothed_probabilities(df: DataFrame, column: str, m: Mixture) -> DataFrame:
    """Add ``p0 ... p{A-1}``: what the mode of a row is drawn from."""
    shares = [f"({_P}e{k} / {_P}t + {mx.SMOOTHING!r}D)" for k in m.kept]
    probabilities = [
        f"CASE WHEN {_P}ok THEN {s} / ({' + '.join(shares)}) END AS p{i}"
        for i, s in enumerate(shares)
    ]
    names = [f"{_P}ok", f"{_P}t", *(f"{_P}e{k}" for k in m.kept)]
    scored = mx.fenced(_scored(df, column, m), _input(df), names)
    return scored.selectExpr(*_input(df), *probabilities)


def sufficient_statistics(df: DataFrame, column: str, m: Mixture) -> DataFrame:
    """One row: ``n*``, ``s*``, ``q*`` (sums of r, r x, r x^2) and ``entropy``.

    A single aggregation with partial sums; rows without a value are left out.
    """
    r = [f"{_P}e{k} / {_P}t AS r{k}" for k in range(m.size)]
    scored = (
        _scored(df, column, m)
        .where(f"{_P}ok")
        .selectExpr(f"{_P}x AS x", f"{_P}m + ln({_P}t) AS norm", *r,
                    *(f"{_P}l{k} AS l{k}" for k in range(m.size)))
    )
    sums = []
    for k in range(m.size):
        sums += [
            F.expr(f"sum(r{k})").alias(f"n{k}"),
            F.expr(f"sum(r{k} * x)").alias(f"s{k}"),
            F.expr(f"sum(r{k} * x * x)").alias(f"q{k}"),
        ]
    logs = " + ".join(f"r{k} * (l{k} - norm)" for k in range(m.size))
    return scored.agg(*sums, F.expr(f"-sum({logs})").alias("entropy"))


def active_components(df: DataFrame, column: str, m: Mixture, eps: float) -> DataFrame:
    """``(component, rows, weight, active)``: a component is active if its weight
    exceeds ``eps`` and it is the likeliest one of at least one row."""
    weights = "array(" + ", ".join(f"{w!r}D" for w in m.weights) + ")"
    rows = (
        hard_assignment(df, column, m)
        .where("component IS NOT NULL")
        .groupBy("component")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    every = df.sparkSession.range(m.size).selectExpr("CAST(id AS INT) AS component")
    # Both sides have one row per component.
    return every.join(rows, "component", "left").selectExpr(
        "component",
        "coalesce(rows, 0L) AS rows",
        f"{weights}[component] AS weight",
        f"coalesce(rows, 0L) > 0 AND {weights}[component] > {eps!r}D AS active",
    )
