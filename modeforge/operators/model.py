"""A fitted mixture as plain numbers, and as a table that can be saved."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from modeforge.functions.special import digamma

PARAMETER_SCHEMA = (
    "column string, k int, weight double, mean double, variance double, beta double, "
    "nu double, a double, b double, active boolean, frequency double, rank int, "
    "rows bigint, cells bigint, iterations int, converged boolean, "
    "lower_bound double"
)


@dataclass(frozen=True)
class FitReport:
    """How a fit went.  Reaching the iteration limit is normal, not a failure."""

    rows: int = 0
    cells: int = 0
    iterations: int = 0
    converged: bool = False
    lower_bound: float = float("nan")
    bounds: tuple[float, ...] = ()


@dataclass(frozen=True)
class Mixture:
    """Variational posterior of a one-dimensional Dirichlet-process mixture.

    ``beta`` and ``nu`` belong to mean and precision of a component, ``a`` and
    ``b`` to its stick; ``frequency`` is the expected number of rows that draw a
    component, which fixes the order of the one-hot columns.
    """

    means: tuple[float, ...]
    variances: tuple[float, ...]
    beta: tuple[float, ...]
    nu: tuple[float, ...]
    a: tuple[float, ...]
    b: tuple[float, ...]
    active: tuple[bool, ...]
    frequency: tuple[float, ...]
    report: FitReport = FitReport()

    @property
    def size(self) -> int:
        return len(self.means)

    @cached_property
    def weights(self) -> tuple[float, ...]:
        """Expected share of each component, normalised."""
        left, shares = 1.0, []
        for a, b in zip(self.a, self.b):
            shares.append(left * a / (a + b))
            left *= b / (a + b)
        whole = math.fsum(shares)
        return tuple(s / whole for s in shares)

    @cached_property
    def consts(self) -> tuple[float, ...]:
        """The part of a component's expected log density that no value changes."""
        return tuple(expected_log_constants(self.variances, self.beta, self.nu, self.a, self.b))

    @cached_property
    def half_precisions(self) -> tuple[float, ...]:
        return tuple(0.5 / v for v in self.variances)

    @cached_property
    def kept(self) -> tuple[int, ...]:
        """Active components in component order; a draw yields a position here."""
        return tuple(k for k in range(self.size) if self.active[k])

    @cached_property
    def kept_means(self) -> tuple[float, ...]:
        return tuple(self.means[k] for k in self.kept)

    @cached_property
    def kept_spreads(self) -> tuple[float, ...]:
        return tuple(math.sqrt(self.variances[k]) for k in self.kept)

    @cached_property
    def order(self) -> tuple[int, ...]:
        """Positions in ``kept`` by descending frequency, ties by position."""
        return tuple(
            sorted(range(len(self.kept)), key=lambda i: (-self.frequency[self.kept[i]], i))
        )


def expected_log_constants(
    variances: Sequence[float],
    beta: Sequence[float],
    nu: Sequence[float],
    a: Sequence[float],
    b: Sequence[float],
) -> list[float]:
    """Per component: normal constant, spread of the precision, stick lengths."""
    consts, passed = [], 0.0
    for v, be, n, ak, bk in zip(variances, beta, nu, a, b):
        both = digamma(ak + bk)
        gauss = -0.5 * (math.log(2.0 * math.pi) + math.log(v) + math.log(n))
        spread = 0.5 * (math.log(2.0) + digamma(0.5 * n) - 1.0 / be)
        consts.append(gauss + spread + digamma(ak) - both + passed)
        passed += digamma(bk) - both
    return consts


def parameters(spark: SparkSession, mixtures: Mapping[str, Mixture]) -> DataFrame:
    """One row per column and component."""
    rows = []
    for column, m in mixtures.items():
        ranks = {m.kept[i]: rank for rank, i in enumerate(m.order)}
        r = m.report
        for k in range(m.size):
            rows.append(
                (
                    column, k, m.weights[k], m.means[k], m.variances[k], m.beta[k], m.nu[k],
                    m.a[k], m.b[k], m.active[k], m.frequency[k], ranks.get(k), r.rows, r.cells,
                    r.iterations, r.converged, r.lower_bound,
                )
            )
    return spark.createDataFrame(rows, PARAMETER_SCHEMA)


def from_parameters(df: DataFrame) -> dict[str, Mixture]:
    """Inverse of ``parameters``; the table has as many rows as components."""
    groups: dict[str, list] = {}
    for row in sorted(df.collect(), key=lambda r: (r["column"], r["k"])):
        groups.setdefault(row["column"], []).append(row)

    def mixture(rows: list) -> Mixture:
        first = rows[0]
        return Mixture(
            *(
                tuple(r[name] for r in rows)
                for name in ("mean", "variance", "beta", "nu", "a", "b", "active", "frequency")
            ),
            FitReport(
                first["rows"], first["cells"], first["iterations"],
                first["converged"], first["lower_bound"],
            ),
        )

    return {column: mixture(rows) for column, rows in groups.items()}
