"""Inflate a small table: many copies of each row, each jittered on its own."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeforge.functions.mixture import finite
from modeforge.functions.text import number, quoted
from modeforge.functions.uniform import key_columns, keyed_uniform

# Rows per output partition when no number of partitions is asked for: many,
# but on a small job no more than it takes to keep all slots busy.
FULL_PARTITION, SMALL_PARTITION = 16_000_000, 100_000
# Fixed value: width of the jitter in deviations.
JITTER_SHARE = 0.1

COPY = "copy"

# Copies generated from one row in one step, and rows per partition that make
# a round-robin spread even.
_LONGEST_BLOCK, _ROWS_TO_SPREAD = 100_000, 64


def copies_for(target: int, rows: int) -> int:
    """Copies needed to reach the target: at least one, rounded up."""
    if rows <= 0:
        raise ValueError("cannot inflate an empty table")
    return max(1, math.ceil(target / rows))


def replicate(
    df: DataFrame,
    copies: int,
    partitions: int | None = None,
    rows: int | None = None,
    label: str = COPY,
) -> DataFrame:
    """``copies`` copies of every row, numbered from 0 in ``label``.

    Copies are generated in two steps, blocks and then the copies of a block.
    With ``partitions`` the rows are spread in between: the shuffle then moves
    one row per block instead of one per copy, and there are just enough blocks
    to spread even a one-row input evenly.
    """
    blocks = math.ceil(copies / _LONGEST_BLOCK)
    if partitions:
        blocks = max(blocks, math.ceil(_ROWS_TO_SPREAD * partitions / max(rows or 1, 1)))
    blocks = min(blocks, copies)
    block = math.ceil(copies / blocks)
    out = df.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    if partitions:
        out = out.repartition(partitions)
    out = out.withColumn("__place", F.explode(F.sequence(F.lit(0), F.lit(block - 1))))
    out = out.withColumn(label, F.expr(f"CAST(__block AS BIGINT) * {block} + __place"))
    if blocks * block > copies:
        out = out.where(F.col(label) < copies)
    return out.drop("__block", "__place")


def jittered(
    column: str,
    stddev: float,
    share: float = JITTER_SHARE,
    key: Sequence[str] = (),
    seed: int = 42,
    portable: bool = False,
) -> str:
    """SQL text of the value moved by up to half of ``share`` deviations."""
    u = keyed_uniform(key, seed, "jitter", portable)
    return f"{quoted(column)} + ({u} - 0.5D) * {number(stddev)} * {number(share)}"


def inflate(
    df: DataFrame,
    column: str,
    target: int,
    *,
    key: str | Sequence[str] | None = None,
    seed: int = 42,
    share: float = JITTER_SHARE,
    partitions: int | None = None,
    keep_key: bool = False,
    portable: bool = False,
) -> DataFrame:
    """At least ``target`` rows of ``column`` (see the module).

    One pass measures the finite values of the column; NaN and infinite ones are
    copied as they are.  With a ``key`` every draw is tied to the row
    and its copy, so a retried task writes the same values again.
    """
    measured = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"stddev_samp({finite(quoted(column))})").alias("stddev"),
    ).first()
    copies = copies_for(target, measured["rows"])
    total = copies * measured["rows"]
    if not partitions:
        slots = df.sparkSession.sparkContext.defaultParallelism
        partitions = max(
            math.ceil(total / FULL_PARTITION), min(slots, math.ceil(total / SMALL_PARTITION))
        )
    names = [key] if isinstance(key, str) else list(key or [])
    slim = df.select(*dict.fromkeys([*names, column]))
    many = replicate(slim, copies, partitions, measured["rows"])
    keys = [*key_columns(key), COPY] if names else []
    value = jittered(column, measured["stddev"] or 0.0, share, keys, seed, portable)
    kept = [*map(quoted, names), COPY] if keep_key else []
    return many.selectExpr(*kept, f"{value} AS {quoted(column)}")
