"""Checks that decoded values still look like, and are, the original ones."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeforge.functions.mixture import finite
from modeforge.functions.text import number, quoted
from modeforge.operators.ks import KsResult, ks_columns, ks_two_sample
from modeforge.operators.quantiles import exact_quantiles

# Fixed value: smallest p-value and largest moment difference that pass.
THRESHOLD = 0.05

_MOMENTS = {"mean": "avg", "std": "stddev_pop", "skew": "skewness", "kurtosis": "kurtosis"}


@dataclass(frozen=True)
class MomentCheck:
    valid: bool
    differences: Mapping[str, float]


@dataclass(frozen=True)
class RoundTrip:
    """What one pass over original and decoded values found."""

    rows: int
    low: float
    high: float
    outside: int
    max_error: float
    damaged: int
    moments: MomentCheck
    finite: tuple[int, int]
    not_finite: int = 0
    changed: int = 0
    inexact: int = 0


@dataclass(frozen=True)
class Validation:
    distribution: KsResult
    round_trip: RoundTrip
    distribution_valid: bool
    bounds_valid: bool
    moments_valid: bool

    @property
    def accuracy(self) -> float:
        """Share of the three checks that passed."""
        return (self.distribution_valid + self.bounds_valid + self.moments_valid) / 3


def distribution_check(
    original: DataFrame, generated: DataFrame, threshold: float = THRESHOLD
) -> tuple[bool, KsResult]:
    """Two-sample test on the first column of each table."""
    result = ks_two_sample(original, generated)
    return result.p_value > threshold, result


def bounds_check(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """``(valid, violations)``: null and NaN count as out of bounds."""
    inside = F.expr(
        f"coalesce({quoted(column)} BETWEEN {number(low)} AND {number(high)}, false)"
    )
    return df.agg(
        F.coalesce(F.bool_and(inside), F.lit(True)).alias("valid"),
        F.count_if(~inside).alias("violations"),
    )


def moments_check(
    original: DataFrame,
    generated: DataFrame,
    threshold: float = THRESHOLD,
    relative: bool = False,
) -> MomentCheck:
    """Differences of the moments of the first column of each table.

    Each table is aggregated to one row.  ``relative`` divides every difference
    by the size of the original moment.
    """
    rows = [
        df.selectExpr(*(f"{fn}({quoted(df.columns[0])}) AS {name}" for name, fn in _MOMENTS.items()))
        .first()
        .asDict()
        for df in (original, generated)
    ]
    return _moment_check(rows[0], rows[1], threshold, relative)


def _moment_check(
    a: Mapping[str, float], b: Mapping[str, float], threshold: float, relative: bool
) -> MomentCheck:
    gaps = {}
    for name in _MOMENTS:
        x, y = a[name], b[name]
        gap = 0.0 if x is None and y is None else abs((x or 0.0) - (y or 0.0))
        gaps[name] = gap / abs(x) if relative and x else gap
    return MomentCheck(all(g < threshold for g in gaps.values()), gaps)


def round_trip(
    df: DataFrame,
    original: str,
    decoded: str,
    threshold: float = THRESHOLD,
    relative: bool = False,
    tolerance: float = 1e-9,
) -> RoundTrip:
    """Compare two columns row by row, in one pass.

    Measures are those of finite values.  ``damaged`` counts rows whose decoded
    value is off by more than ``tolerance`` times the spread of the original, or
    is missing; ``outside`` counts those beyond the range of the original by more
    than that.  A second pass counts them only if the first one has found any.
    ``not_finite`` counts NaN and infinite originals, and ``changed`` those of
    them that were decoded to something else; a decoded null is no damage there,
    as encoding without overflow leaves them out.  ``inexact`` counts all rows whose
    decoded value is not the original one to the last digit, nulls and NaN included.
    """
    same = f"{quoted(original)} <=> {quoted(decoded)}"
    x, y = f"CAST({quoted(original)} AS DOUBLE)", f"CAST({quoted(decoded)} AS DOUBLE)"
    pair = df.selectExpr(f"{x} AS rx", f"{y} AS ry", f"{same} AS same").selectExpr(
        "rx", "ry", "same", f"{finite('rx')} AS x", f"{finite('ry')} AS y"
    )
    row = pair.selectExpr(
        "count(1) AS rows",
        "min(x) AS low",
        "max(x) AS high",
        "min(y) AS low_y",
        "max(y) AS high_y",
        "max(abs(x - y)) AS max_error",
        "count_if(NOT same) AS inexact",
        "count_if(x IS NOT NULL AND y IS NULL) AS missing",
        "count_if(x IS NULL AND rx IS NOT NULL) AS not_finite",
        "count_if(x IS NULL AND rx IS NOT NULL AND ry IS NOT NULL AND NOT (rx <=> ry)) AS changed",
        *(f"count({c}) AS finite_{c}" for c in "xy"),
        *(f"{fn}({c}) AS {name}_{c}" for c in "xy" for name, fn in _MOMENTS.items()),
    ).first()
    if row["low"] is None:
        raise ValueError(f"no value to compare in {original}")
    allowed = tolerance * max(row["std_x"] or 0.0, 1.0)
    low, high = row["low"] - allowed, row["high"] + allowed
    outside = damaged = 0
    whole = row["missing"] == 0 and row["low_y"] is not None
    inside = whole and low <= row["low_y"] and row["high_y"] <= high
    if not inside or row["max_error"] > allowed:
        counts = pair.selectExpr(
            f"count_if(NOT coalesce(y BETWEEN {number(low)} AND {number(high)}, x IS NULL)) AS outside",
            f"count_if(NOT coalesce(abs(x - y) <= {number(allowed)}, x IS NULL)) AS damaged",
        ).first()
        outside, damaged = counts["outside"], counts["damaged"]
    check = _moment_check(
        {name: row[f"{name}_x"] for name in _MOMENTS},
        {name: row[f"{name}_y"] for name in _MOMENTS},
        threshold,
        relative,
    )
    return RoundTrip(
        row["rows"], row["low"], row["high"], outside, row["max_error"],
        damaged + row["changed"], check, (row["finite_x"], row["finite_y"]),
        row["not_finite"], row["changed"], row["inexact"],
    )


def error_by_decile(df: DataFrame, original: str, decoded: str) -> DataFrame:
    """``(decile, rows, max_error)``: where along the values the error lies.

    Edges are the exact nine quantiles of the finite values; other rows are left out.
    """
    x = finite(quoted(original))
    edges = exact_quantiles(df, x, [i / 10 for i in range(1, 10)])
    whens = " ".join(f"WHEN x <= {number(e)} THEN {i + 1}" for i, e in enumerate(edges))
    decile = f"CASE {whens} ELSE 10 END" if whens else "10"
    return (
        df.selectExpr(f"{x} AS x", f"{finite(quoted(decoded))} AS y")
        .where("x IS NOT NULL")
        .selectExpr(f"{decile} AS decile", "abs(x - y) AS e")
        .groupBy("decile")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("e").alias("max_error"))
    )


def validate_columns(
    df: DataFrame,
    original: str,
    decoded: str,
    threshold: float = THRESHOLD,
    relative: bool = False,
) -> Validation:
    """Distribution, bounds and moments of two columns of one table."""
    trip = round_trip(df, original, decoded, threshold, relative)
    ks = ks_columns(df, original, decoded, trip.finite)
    return Validation(ks, trip, ks.p_value > threshold, trip.outside == 0, trip.moments.valid)
