"""What a task computes over its blocks of values and counts.

These functions travel to the executors by value, so the package need not be
installed there.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from modeforge.functions.mixture import SMOOTHING

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Values handled at once, so that the arrays stay in the processor's cache.
_CHUNK = 2048

SCHEMA = StructType(
    [
        StructField("chain", IntegerType()),
        StructField("part", IntegerType()),
        StructField("sums", ArrayType(DoubleType())),
    ]
)

Measure = Callable[..., np.ndarray]


def partition_sums(
    work: Mapping[int, Sequence[tuple[int, tuple]]], measure: Measure
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sum ``measure`` over the blocks of a partition, per parameter set.

    ``work`` lists the parameter sets (with their numbers) of each column.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}
        part = 0
        for block in blocks(batches):
            part = block.part
            for lo in range(0, len(block.z), _CHUNK):
                own = slice(lo, lo + _CHUNK)
                for i, params in work.get(block.model, ()):
                    s = measure(block.z[own], block.n[own], *params)
                    acc[i] = acc[i] + s if i in acc else s
        yield from _rows(acc, part)

    return run


def start_sums(
    offsets: Mapping[tuple[int, int], float], totals: Sequence[float], edges: Sequence[np.ndarray]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts and moments of the bins between ``edges``, shares of a column's rows in order.

    ``offsets`` has a column's rows in earlier partitions.  Set number ``model * len(edges) + run``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}
        part = 0
        for block in blocks(batches):
            part, z, n = block.part, block.z, block.n
            passed = offsets[block.part, block.model] + block.before + np.cumsum(n) - n / 2
            share = passed / totals[block.model]
            for i, cuts in enumerate(edges):
                k = len(cuts) + 1
                place = np.searchsorted(cuts, share, side="right")
                s = np.concatenate([np.bincount(place, w, k) for w in (n, n * z, n * z * z)])
                key = block.model * len(edges) + i
                acc[key] = acc[key] + s if key in acc else s
        yield from _rows(acc, part)

    return run


def cut_sums(
    cuts: Sequence[np.ndarray], runs: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts and moments of the values between ``cuts``; set number as in ``start_sums``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}
        part = 0
        for block in blocks(batches):
            part, z, n = block.part, block.z, block.n
            # Values are in order, so the sums between cuts are differences of running sums.
            running = [np.concatenate([[0.0], np.cumsum(w)]) for w in (n, n * z, n * z * z)]
            for key in range(block.model * runs, (block.model + 1) * runs):
                at = np.concatenate([[0], np.searchsorted(z, cuts[key], side="left"), [len(z)]])
                s = np.concatenate([np.diff(w[at]) for w in running])
                acc[key] = acc[key] + s if key in acc else s
        yield from _rows(acc, part)

    return run


def added(partial: DataFrame, chains: int) -> DataFrame:
    """One row per parameter set from the rows of all tasks, added in the order of the partitions."""
    met = partial.repartition(chains, "chain").sortWithinPartitions("chain", "part")
    return met.mapInArrow(_add, SCHEMA)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    acc: dict[int, np.ndarray] = {}
    for batch in batches:
        for chain, sums in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            s = np.array(sums)
            acc[chain] = acc[chain] + s if chain in acc else s
    yield from _rows(acc, 0)


class Block(NamedTuple):
    part: int
    model: int
    before: float
    z: np.ndarray
    n: np.ndarray


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        part, model, before = (batch.column(i).to_pylist() for i in range(3))
        z, n = batch.column(5), batch.column(6)
        for i in range(len(part)):
            arrays = (np.frombuffer(c[i].as_buffer(), np.float64) for c in (z, n))
            yield Block(part[i], model[i], before[i], *arrays)


def _rows(acc: Mapping[int, np.ndarray], part: int) -> Iterator[pa.RecordBatch]:
    if acc:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(acc), pa.int32()),
                pa.array([part] * len(acc), pa.int32()),
                pa.array([v.tolist() for v in acc.values()], pa.list_(pa.float64())),
            ],
            names=["chain", "part", "sums"],
        )


def _logs(z, const, half, mean):
    """Distances from the means, their squares and log densities, one line per component."""
    d = z - mean[:, None]
    d2 = d * d
    return d, d2, const[:, None] - half[:, None] * d2


def _shares(logs):
    top = logs.max(axis=0)
    e = np.exp(logs - top)
    whole = e.sum(axis=0)
    e /= whole
    return e, top + np.log(whole)


def _line_sums(a, b):
    return np.einsum("kn,kn->k", a, b)


def moment_sums(z, n, const, half, mean, _active):
    """Counts, first and second moments about the means, entropy."""
    d, d2, logs = _logs(z, const, half, mean)
    r, norm = _shares(logs)
    r *= n
    entropy = (n * norm).sum() - _line_sums(r, logs).sum()
    return np.concatenate([r.sum(axis=1), _line_sums(r, d), _line_sums(r, d2), [entropy]])


def win_counts(z, n, const, half, mean, _active):
    """Rows per likeliest component."""
    logs = _logs(z, const, half, mean)[2]
    return np.bincount(logs.argmax(axis=0), weights=n, minlength=len(mean))


def draw_counts(z, n, const, half, mean, active):
    """Expected rows per drawn component."""
    p = (_shares(_logs(z, const, half, mean)[2])[0] + SMOOTHING) * active[:, None]
    return (p * (n / p.sum(axis=0))).sum(axis=1)
