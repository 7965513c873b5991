"""Exact two-sample Kolmogorov-Smirnov test on whole columns.

Equal values are merged first (with partial sums before the shuffle, so a hot
value is one row from then on), the distinct values are range partitioned and
sorted, and every partition reports its totals and the extremes of its own
running difference.  Putting the partitions in line is then a prefix sum over
one row per partition; no task ever sees more than its range of values.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeforge.functions.mixture import finite
from modeforge.functions.text import quoted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PART = "first double, a double, b double, low double, high double"


@dataclass(frozen=True)
class KsResult:
    statistic: float
    p_value: float
    n: int
    m: int


# Rows of either sample up to which the exact distribution is worked out.
EXACT_ROWS = 10_000


def ks_two_sample(a: DataFrame, b: DataFrame, method: str = "asymptotic") -> KsResult:
    """Compare the first column of ``a`` with the first column of ``b``.

    ``method`` says how the p-value is found: from the ``asymptotic`` distribution, the ``exact`` one,
    which is an error beyond ``EXACT_ROWS`` rows, or ``auto``: exact up to so many, else asymptotic.
    """
    left = a.selectExpr(f"{finite(quoted(a.columns[0]))} AS x", "1L AS a", "0L AS b")
    right = b.selectExpr(f"{finite(quoted(b.columns[0]))} AS x", "0L AS a", "1L AS b")
    return _compare(left.unionAll(right), method=method)


def ks_columns(
    df: DataFrame, first: str, second: str, sizes: tuple[int, int] | None = None,
    method: str = "asymptotic",
) -> KsResult:
    """Compare two columns of one table.

    ``sizes`` are the numbers of finite values, which saves counting them.
    """
    pair = f"{finite(quoted(first))}, 1L, 0L, {finite(quoted(second))}, 0L, 1L"
    return _compare(df.selectExpr(f"stack(2, {pair}) AS (x, a, b)"), sizes, method)


def _compare(
    tagged: DataFrame, sizes: tuple[int, int] | None = None, method: str = "asymptotic"
) -> KsResult:
    if method not in ("asymptotic", "exact", "auto"):
        raise ValueError("method must be 'asymptotic', 'exact' or 'auto'")
    merged = (
        tagged.where("x IS NOT NULL")
        .groupBy("x")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    )
    if sizes is None:
        counted = tagged.where("x IS NOT NULL").agg(F.sum("a"), F.sum("b")).first()
        sizes = (counted[0] or 0, counted[1] or 0)
    n, m = sizes
    if n == 0 or m == 0:
        raise ValueError("both samples need at least one finite value")
    exact = method == "exact" or (method == "auto" and max(n, m) <= EXACT_ROWS)
    if exact and max(n, m) > EXACT_ROWS:
        raise ValueError(f"the exact distribution is for samples of at most {EXACT_ROWS} rows")
    parts = (
        merged.repartitionByRange("x").sortWithinPartitions("x").mapInArrow(_extremes(n, m), _PART)
    ).collect()
    statistic, base = 0.0, 0.0
    taken_a = taken_b = 0.0
    for part in sorted(parts):
        base = taken_a / n - taken_b / m
        statistic = max(statistic, abs(base + part["low"]), abs(base + part["high"]))
        taken_a += part["a"]
        taken_b += part["b"]
    p_value = ks_exact_p_value(statistic, n, m) if exact else ks_p_value(statistic, n, m)
    return KsResult(statistic, p_value, n, m)


def _extremes(
    n: int, m: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Totals of a sorted partition and the extremes of its running difference."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, seen_a, seen_b, low, high = None, 0, 0, math.inf, -math.inf
        for batch in batches:
            x, a, b = (batch.column(i).to_numpy() for i in range(3))
            if not len(x):
                continue
            first = float(x[0]) if first is None else first
            gap = (seen_a + np.cumsum(a)) / n - (seen_b + np.cumsum(b)) / m
            low, high = min(low, float(gap.min())), max(high, float(gap.max()))
            seen_a, seen_b = seen_a + int(a.sum()), seen_b + int(b.sum())
        if first is not None:
            row = {"first": first, "a": seen_a, "b": seen_b, "low": low, "high": high}
            yield pa.RecordBatch.from_pydict({k: [float(v)] for k, v in row.items()})

    return run


def ks_p_value(statistic: float, n: int, m: int) -> float:
    """Limiting distribution of the scaled statistic (Kolmogorov series)."""
    scaled = statistic * math.sqrt(n * m / (n + m))
    if scaled < 0.2:
        # The series would need many terms; its sum is 1 to 12 digits here.
        return 1.0
    terms = (
        (-1) ** (j - 1) * math.exp(-2.0 * j * j * scaled * scaled) for j in range(1, 101)
    )
    return min(1.0, max(0.0, 2.0 * math.fsum(terms)))


def ks_exact_p_value(statistic: float, n: int, m: int) -> float:
    """Share of the orders of ``n`` and ``m`` different values whose statistic is at least this one.

    An order is a path from (0, 0) to (n, m), and its statistic the largest ``|i/n - j/m|`` on it. The
    share of paths that have reached a point (i, j) after touching the limit follows from the two points
    before it, so diagonal by diagonal all points are worked out. Shares are added, never subtracted,
    so small ones keep their digits.
    """
    if n > m:
        n, m = m, n
    common = math.gcd(n, m)
    right, up = m // common, n // common
    limit = math.ceil(statistic * n * m / common - 1e-6)
    if limit <= 0:
        return 1.0
    touched = np.zeros(n + 1)
    for s in range(1, n + m + 1):
        i = np.arange(max(0, s - m), min(n, s) + 1)
        j = s - i
        share = (touched[i - 1] * i + touched[i] * j) / s
        touched[i] = np.where(np.abs(i * right - j * up) >= limit, 1.0, share)
    return float(touched[n])
