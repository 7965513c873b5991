"""Exact quantiles of a column of any length."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeforge.sources.scratch import cut_lineage


def exact_quantiles(df: DataFrame, x: str, shares: Sequence[float]) -> list[float]:
    """For each share the smallest value with at least that share of the rows up to it.

    Equal values are merged before they are range partitioned; the rows before a partition come from
    one number of each, and only the partitions that hold a quantile are looked at again.  Empty
    without a value.
    """
    counts = (
        df.selectExpr(f"{x} AS x").where("x IS NOT NULL").groupBy("x").agg(F.count("*").alias("n"))
    )
    placed = cut_lineage(
        counts.repartitionByRange("x").select(F.spark_partition_id().alias("part"), "x", "n")
    )
    sums = sorted(placed.groupBy("part").agg(F.sum("n").alias("n")).collect())
    total = sum(r["n"] for r in sums)
    out = []
    for share in shares if total else []:
        # Rounding must not push a whole number up, as 0.7 * 10 would.
        rank = max(1, math.ceil(share * total - 1e-9 * max(1, total)))
        before = 0
        for r in sums:
            if before + r["n"] >= rank:
                out.append((r["part"], rank - before))
                break
            before += r["n"]
    found: dict[int, list[int]] = {}
    for part, rank in out:
        found.setdefault(part, []).append(rank)
    values = {}
    for part, ranks in found.items():
        # The running count of one partition's range of values.
        running = placed.where(F.col("part") == part).selectExpr(
            "x", "sum(n) OVER (PARTITION BY part ORDER BY x) AS upto"
        )
        mins = running.agg(
            *(F.min(F.when(F.col("upto") >= rank, F.col("x"))).alias(str(rank)) for rank in set(ranks))
        ).first()
        values |= {(part, rank): mins[str(rank)] for rank in ranks}
    return [values[key] for key in out]
