"""Variational fit of one-dimensional Dirichlet-process mixtures on Spark.

The packed values and counts (``operators.compress``) are the data of the fit, the
distinct values of every column whatever their number.  Each iteration is one
Spark job over them: every task turns its blocks into sums per component, 3 K + 1
doubles per column, which are added up in the cluster.  The number of tasks
follows the slots and not the values; one row per column reaches the driver,
which holds nothing but the component parameters.

All columns, and all restarts of a column, advance in the same job.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from modeforge.config import MixtureConfig
from modeforge.functions.special import log_beta
from modeforge.functions.text import quoted
from modeforge.operators.compress import NumericProfile, compress, pack, profile_numeric
from modeforge.operators.model import FitReport, Mixture, expected_log_constants
from modeforge.operators.sums import (
    SCHEMA,
    Measure,
    added,
    cut_sums,
    draw_counts,
    moment_sums,
    partition_sums,
    start_sums,
    win_counts,
)
from modeforge.sources.scratch import cut_lineage

# Fixed value: guards the division by an empty component.
_TINY = 10 * np.finfo(float).eps

# Values that one task should handle per iteration, at least and at most, and rounds of tasks at the most.
_FEW_CELLS, _MANY_CELLS, _ROUNDS = 8_192, 131_072, 4

# Steps of k-means at the most, and a move of all means (in spreads) that ends it.
_K_MEANS_STEPS, _K_MEANS_TOLERANCE = 30, 1e-6

# So many rows per column are added by the driver itself, as a shuffle takes longer.
_DIRECT = 64


def fit_mixture(df: DataFrame, column: str, config: MixtureConfig | None = None) -> Mixture:
    """Fit one numeric column; null, NaN and infinite values are left out."""
    return fit_mixtures(df, {column: quoted(column)}, config)[column]


def fit_mixtures(
    df: DataFrame,
    columns: Mapping[str, str],
    config: MixtureConfig | None = None,
) -> dict[str, Mixture]:
    """Fit every named SQL expression, all in the same jobs."""
    cfg = config or MixtureConfig()
    profiles, _ = profile_numeric(df, columns)
    return fit_profiled(df, columns, profiles, cfg)


def fit_profiled(
    df: DataFrame,
    columns: Mapping[str, str],
    profiles: Mapping[str, NumericProfile],
    cfg: MixtureConfig,
) -> dict[str, Mixture]:
    """As ``fit_mixtures`` for columns whose profiles are known."""
    names = list(columns)
    for name in names:
        if profiles[name].rows == 0:
            raise ValueError(f"no finite value to fit in {name}")
    cells = cut_lineage(compress(df, columns, profiles))
    held = _hold(cells, len(names))
    try:
        chains = _initial_chains(held, [profiles[n] for n in names], cfg)
        _iterate(held, chains, cfg)
        best = [
            max((c for c in chains if c.model == i), key=lambda c: c.bounds[-1])
            for i in range(len(names))
        ]
        _label(held, best, cfg)
    finally:
        held.blocks.unpersist()
    return {
        name: best[i].mixture(profiles[name], held.cells[i])
        for i, name in enumerate(names)
    }


@dataclass(frozen=True)
class _Held:
    """The blocks, the tasks that read them and the distinct values of every column."""

    blocks: DataFrame
    tasks: int
    cells: list[int]

    def sums(self, run: Callable, chains: int, width: int) -> np.ndarray:
        """One job: the sums of every chain."""
        rows = self.blocks.mapInArrow(run, SCHEMA)
        if self.tasks > _DIRECT:
            rows = added(rows, chains)
        out = np.zeros((chains, width))
        for row in sorted(rows.collect(), key=lambda r: r["part"]):
            out[row["chain"]] += row["sums"]
        return out


def _hold(cells: DataFrame, models: int) -> _Held:
    """Pack the values and keep the blocks in memory in partitions fit for the iterations."""
    counted = {r["model"]: r["count"] for r in cells.groupBy("model").count().collect()}
    rows = sum(counted.values())
    slots = cells.sparkSession.sparkContext.defaultParallelism
    tasks = min(math.ceil(rows / _FEW_CELLS), slots)
    if rows > slots * _MANY_CELLS:
        # Whole rounds of tasks, so that the last round is not nearly empty; blocks are streamed,
        # so a task may have any number of them.
        tasks = slots * min(_ROUNDS, math.ceil(rows / (slots * _MANY_CELLS)))
    # The checkpoint fixes the numbers of the partitions for good.
    held = cut_lineage(pack(cells, tasks)).persist(StorageLevel.MEMORY_AND_DISK)
    return _Held(held, tasks, [counted[i] for i in range(models)])


# --------------------------------------------------------------------------
# parameters of one fit under way


@dataclass
class _Chain:
    """One column (``model``) in one restart (``run``); values are standardised."""

    model: int
    run: int
    prior_variance: float
    reg: float
    gamma: float
    mean: np.ndarray = field(default=None)
    variance: np.ndarray = field(default=None)
    beta: np.ndarray = field(default=None)
    nu: np.ndarray = field(default=None)
    a: np.ndarray = field(default=None)
    b: np.ndarray = field(default=None)
    bounds: list[float] = field(default_factory=list)
    converged: bool = False
    active: np.ndarray = field(default=None)
    frequency: np.ndarray = field(default=None)

    def update(self, n: np.ndarray, s1: np.ndarray, s2: np.ndarray, about: np.ndarray) -> None:
        """New parameters from counts and moments taken ``about`` some values."""
        held = n + _TINY
        centre = (s1 + about * n) / held
        off = centre - about
        spread = np.maximum(s2 - 2.0 * off * s1 + off * off * n, 0.0) / held + self.reg
        self.beta = 1.0 + held
        self.nu = 1.0 + held
        self.mean = held * centre / self.beta
        pull = held / self.beta * centre * centre
        self.variance = np.maximum(
            (self.prior_variance + held * spread + pull) / self.nu, self.reg
        )
        self.a = 1.0 + held
        self.b = self.gamma + np.concatenate([np.cumsum(held[::-1])[::-1][1:], [0.0]])

    def bound(self, entropy: float) -> float:
        """Lower bound up to a constant of the column."""
        half_log = -0.5 * np.log(self.variance) - 0.5 * np.log(self.nu)
        gammas = np.array([math.lgamma(0.5 * v) for v in self.nu])
        wishart = -(self.nu * half_log + 0.5 * math.log(2.0) * self.nu + gammas)
        sticks = sum(log_beta(a, b) for a, b in zip(self.a, self.b))
        return float(entropy - wishart.sum() + sticks - 0.5 * np.log(self.beta).sum())

    def densities(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        consts = expected_log_constants(
            self.variance.tolist(), self.beta.tolist(), self.nu.tolist(),
            self.a.tolist(), self.b.tolist(),
        )
        return np.array(consts), 0.5 / self.variance, self.mean

    def shares(self) -> np.ndarray:
        left = np.concatenate([[1.0], np.cumprod(self.b / (self.a + self.b))[:-1]])
        w = left * self.a / (self.a + self.b)
        return w / w.sum()

    def mixture(self, profile: NumericProfile, cells: int) -> Mixture:
        scale = profile.scale
        return Mixture(
            tuple((profile.mean + scale * self.mean).tolist()),
            tuple((scale * scale * self.variance).tolist()),
            tuple(self.beta.tolist()),
            tuple(self.nu.tolist()),
            tuple(self.a.tolist()),
            tuple(self.b.tolist()),
            tuple(bool(v) for v in self.active),
            tuple(self.frequency.tolist()),
            FitReport(
                profile.rows, cells, len(self.bounds), self.converged,
                self.bounds[-1], tuple(self.bounds),
            ),
        )


# --------------------------------------------------------------------------
# the steps


def _initial_chains(
    held: _Held, profiles: list[NumericProfile], cfg: MixtureConfig
) -> list[_Chain]:
    """Hard start: bins of equal row count for run 0, seeded bins for further runs.

    With ``start="kmeans"`` all runs begin with seeded bins, which k-means then moves.  Partitions are ranges of the values in order, so the place of a value in the
    order is its running count in the partition behind the sum of those before.
    """
    k = cfg.n_components
    seeded = cfg.start == "kmeans"
    edges = [] if seeded else [np.arange(1, k) / k]
    for run in range(len(edges), cfg.n_init):
        edges.append(np.sort(np.random.default_rng([cfg.random_state, run]).random(k - 1)))
    totals = [0.0] * len(profiles)
    offsets = {}
    parts = held.blocks.groupBy("part", "model").agg(F.sum("rows").alias("rows")).collect()
    for r in sorted(parts):
        offsets[r["part"], r["model"]] = totals[r["model"]]
        totals[r["model"]] += r["rows"]
    sums = held.sums(start_sums(offsets, totals, edges), len(profiles) * cfg.n_init, 3 * k)
    if seeded:
        sums = _k_means(held, sums, k, cfg.n_init)
    sums = sums.reshape(len(profiles), cfg.n_init, 3, k)
    chains = []
    for model, profile in enumerate(profiles):
        for run in range(cfg.n_init):
            chain = _Chain(
                model,
                run,
                profile.prior_variance,
                cfg.reg_covar / (profile.scale * profile.scale),
                cfg.weight_concentration_prior,
            )
            chain.update(*sums[model, run], np.zeros(k))
            chains.append(chain)
    return chains


def _k_means(held: _Held, sums: np.ndarray, k: int, runs: int) -> np.ndarray:
    """Lloyd's steps in one dimension, all columns and runs in the same jobs.

    A step takes the values to the closest mean, so a bin ends half way between two means.  Values are in
    order, so their sums come from running sums.  An empty bin keeps its place.
    """
    centres = np.zeros((len(sums), k))
    for _ in range(_K_MEANS_STEPS):
        n, s1 = sums[:, :k], sums[:, k : 2 * k]
        moved = np.sort(np.where(n > 0, s1 / np.maximum(n, 1.0), centres), axis=1)
        still = np.abs(moved - centres).max() < _K_MEANS_TOLERANCE
        centres = moved
        if still:
            break
        cuts = [(c[1:] + c[:-1]) / 2 for c in centres]
        sums = held.sums(cut_sums(cuts, runs), len(sums), 3 * k)
    return sums


def _iterate(held: _Held, chains: list[_Chain], cfg: MixtureConfig) -> None:
    """Expectation and maximisation until every chain has settled."""
    k = cfg.n_components
    moving = list(chains)
    for _ in range(cfg.max_iter):
        sums = _sum_over_cells(held, moving, moment_sums, 3 * k + 1)
        for chain, s in zip(moving, sums):
            chain.update(s[:k], s[k : 2 * k], s[2 * k : 3 * k], chain.mean)
            chain.bounds.append(chain.bound(s[3 * k]))
            chain.converged = (
                len(chain.bounds) > 1 and abs(chain.bounds[-1] - chain.bounds[-2]) < cfg.tol
            )
        moving = [c for c in moving if not c.converged]
        if not moving:
            break


def _label(held: _Held, chains: list[_Chain], cfg: MixtureConfig) -> None:
    """Which components stay, and how often each of them will be drawn.

    A component stays if its share exceeds ``eps`` and it is the likeliest one
    of some row; if none does, the heaviest stays.
    """
    k = cfg.n_components
    for chain, wins in zip(chains, _sum_over_cells(held, chains, win_counts, k)):
        shares = chain.shares()
        chain.active = (shares > cfg.eps) & (wins > 0)
        if not chain.active.any():
            chain.active[int(np.argmax(shares))] = True
    for chain, drawn in zip(chains, _sum_over_cells(held, chains, draw_counts, k)):
        chain.frequency = drawn


def _sum_over_cells(
    held: _Held, chains: list[_Chain], measure: Measure, width: int
) -> np.ndarray:
    """One job: ``measure`` summed over all cells of each chain's column."""
    work: dict[int, list] = {}
    for i, chain in enumerate(chains):
        work.setdefault(chain.model, []).append((i, (*chain.densities(), chain.active)))
    return held.sums(partition_sums(work, measure), len(chains), width)
