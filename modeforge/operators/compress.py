"""The distinct values of numeric columns with their row counts, packed for the fit.

Step one of the fit is a single scan that measures every column at once.  Step two, a single scan too,
counts the values of all columns.  Equal values are merged before the shuffle, so a hot value is one row
of each task: of a few columns by partial aggregation, of many in tables of bounded size that a task
hands on whenever they are full.  The groups are range partitioned in the order of column and value and
packed into binary blocks of some thousand values, one row each, which every iteration reads as
arrays.  Nothing is merged or rounded, whatever the number of values.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeforge.functions.mixture import finite
from modeforge.functions.text import number

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Up to so many columns are turned into rows for Spark's own aggregation.
_FEW_COLUMNS = 8

# Values of all columns that a task holds before it hands them on: some 30 MB with their merging.
TABLE = 1_000_000

# Values in a block.
BLOCK = 8_192

BLOCK_SCHEMA = "part int, model int, before double, rows double, cells int, z binary, n binary"


@dataclass(frozen=True)
class NumericProfile:
    """Measures of the finite values of one column."""

    rows: int
    mean: float
    variance: float
    low: float
    high: float

    @property
    def scale(self) -> float:
        return math.sqrt(self.variance) if self.variance > 0 else 1.0

    @property
    def prior_variance(self) -> float:
        """Sample variance in units of ``scale``: 1, or 0 for a constant."""
        return 1.0 if self.variance > 0 else 0.0


def profile_numeric(
    df: DataFrame, columns: Mapping[str, str], extra: Mapping[str, str] | None = None
) -> tuple[dict[str, NumericProfile], dict[str, object]]:
    """Profile of every named SQL expression, and ``extra`` aggregates, in one scan."""
    names, extra = list(columns), dict(extra or {})
    staged = df.selectExpr("*", *(f"{finite(columns[n])} AS __v{i}" for i, n in enumerate(names)))
    row = staged.selectExpr(
        *(f"{text} AS x{i}" for i, text in enumerate(extra.values())),
        *(
            text
            for i in range(len(names))
            for text in (
                f"count(__v{i}) AS n{i}",
                f"avg(__v{i}) AS m{i}",
                f"var_samp(__v{i}) AS s{i}",
                f"min(__v{i}) AS a{i}",
                f"max(__v{i}) AS b{i}",
            )
        )
    ).first()
    profiles = {}
    for i, name in enumerate(names):
        if row[f"n{i}"] == 0:
            profiles[name] = NumericProfile(0, 0.0, 0.0, 0.0, 0.0)
            continue
        variance = row[f"s{i}"]
        flat = variance is None or row[f"a{i}"] == row[f"b{i}"]
        profiles[name] = NumericProfile(
            row[f"n{i}"],
            row[f"a{i}"] if flat else row[f"m{i}"],
            0.0 if flat else variance,
            row[f"a{i}"],
            row[f"b{i}"],
        )
    return profiles, {name: row[f"x{i}"] for i, name in enumerate(extra)}


def compress(
    df: DataFrame, columns: Mapping[str, str], profiles: Mapping[str, NumericProfile]
) -> DataFrame:
    """Rows ``(model, z, n)``: standardised value and row count.

    ``model`` is the position of the column in ``columns``.
    """
    names = list(columns)
    values = df.selectExpr(*(f"{finite(columns[n])} AS v{i}" for i, n in enumerate(names)))
    if len(names) <= _FEW_COLUMNS:
        pairs = ", ".join(f"{i}, v{i}" for i in range(len(names)))
        counted = values.selectExpr(f"stack({len(names)}, {pairs}) AS (model, v)").where("v IS NOT NULL").groupBy("model", "v")
        grouped = counted.agg(F.count(F.lit(1)).alias("rows"))
    else:
        counted = values.mapInArrow(value_tables, "model int, v double, n bigint").groupBy("model", "v")
        grouped = counted.agg(F.sum("n").alias("rows"))
    centre = _per_model([number(profiles[n].mean) for n in names])
    scale = _per_model([number(profiles[n].scale) for n in names])
    return grouped.selectExpr(
        "model", f"(v - {centre}) / {scale} AS z", "CAST(rows AS DOUBLE) AS n"
    )


def value_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(model, v, n)``: how often every column has each value, in tables of at most ``TABLE`` values and a batch."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0
    for batch in batches:
        for model, column in enumerate(batch.columns):
            values, counts = np.unique(column.drop_null().to_numpy(), return_counts=True)
            if len(values):
                held.setdefault(model, []).append((values, counts))
                size += len(values)
        if size > TABLE:
            held = {model: [_merged(parts)] for model, parts in held.items()}
            size = sum(len(parts[0][0]) for parts in held.values())
            if size > TABLE // 2:
                yield from _handed_on(held)
                held, size = {}, 0
    yield from _handed_on(held)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    values = np.concatenate([v for v, _ in parts])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], np.concatenate([n for _, n in parts])[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[first], np.add.reduceat(counts, first)


def _handed_on(held: Mapping[int, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
    for model, parts in held.items():
        values, counts = _merged(parts)
        for lo in range(0, len(values), BLOCK):
            own = slice(lo, lo + BLOCK)
            n = counts[own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), model, np.int32)), pa.array(values[own]), pa.array(n.astype(np.int64))],
                ["model", "v", "n"],
            )


def pack(cells: DataFrame, tasks: int) -> DataFrame:
    """Blocks of the values in order; ``before`` counts the column's earlier rows in the partition."""
    return (
        cells.repartitionByRange(tasks, "model", "z")
        .sortWithinPartitions("model", "z")
        .selectExpr("spark_partition_id() AS part", "model", "z", "n")
        .mapInArrow(_packed, BLOCK_SCHEMA)
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before: dict[int, float] = {}
    for batch in batches:
        part, model, z, n = (batch.column(i).to_numpy() for i in range(4))
        rows = []
        for start, end in _runs(model):
            for lo in range(start, end, BLOCK):
                own = slice(lo, min(lo + BLOCK, end))
                key, total = int(model[lo]), float(n[own].sum())
                seen = before.get(key, 0.0)
                before[key] = seen + total
                rows.append(
                    (int(part[lo]), key, seen, total, own.stop - lo, z[own].tobytes(), n[own].tobytes())
                )
        if rows:
            names = ("part", "model", "before", "rows", "cells", "z", "n")
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kind) for v, kind in zip(zip(*rows), kinds)], list(names)
            )


def _runs(model: np.ndarray) -> list[tuple[int, int]]:
    starts = np.flatnonzero(np.diff(model, prepend=-1))
    return list(zip(starts.tolist(), [*starts[1:].tolist(), len(model)]))


def _per_model(values: list[str]) -> str:
    if len(set(values)) == 1:
        return values[0]
    return "CASE model " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"
