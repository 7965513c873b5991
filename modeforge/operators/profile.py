"""Counts, measures and category rankings of columns, as DataFrames.

Each function is one aggregation with partial sums before any shuffle, however
many columns it covers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modeforge.functions.text import quoted, string
from modeforge.sources.scratch import kept_table


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, count, mean, stddev, min, max)`` with numeric types."""
    measures = {
        "count": "count",
        "mean": "avg",
        "stddev": "stddev_samp",
        "min": "min",
        "max": "max",
    }
    return _per_column(df, columns, measures)


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, min, max)`` without the quartiles that nobody asked for."""
    return _per_column(df, columns, {"min": "min", "max": "max"})


def mean_stddev(df: DataFrame, column: str) -> DataFrame:
    """Mean and sample standard deviation, the scale of the jitter."""
    return df.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("stddev"))


def moments(df: DataFrame, column: str) -> DataFrame:
    """Mean, population deviation, biased skewness, excess kurtosis."""
    return df.agg(
        F.avg(column).alias("mean"),
        F.stddev_pop(column).alias("std"),
        F.skewness(column).alias("skew"),
        F.kurtosis(column).alias("kurtosis"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column once each; null is a value of its own."""
    return df.select(column).distinct()


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, count)`` for all columns in one pass, nulls left out.

    Values are in their string form.
    """
    pairs = ", ".join(f"{string(c)}, CAST({quoted(c)} AS STRING)" for c in columns)
    return (
        df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column, value)")
        .where("value IS NOT NULL")
        .groupBy("column", "value")
        .count()
    )


def ranked_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, count, idx)``: categories by descending frequency.

    Ties go by value.  The ranking is a range-partitioned sort, kept as written; a category's index
    is its place in its partition plus the column's categories in the partitions before it.
    """
    ordered = category_counts(df, columns).orderBy("column", F.desc("count"), F.asc("value"))
    return _placed(ordered, ["column"]).select("column", "value", "count", "idx")


def _placed(ordered: DataFrame, groups: list[str]) -> DataFrame:
    """Sorted rows, ``groups`` first, with ``idx``: their place in their group."""
    # The upper bits of the id are the partition, the lower 33 the place in it.
    placed = kept_table(ordered.withColumn("id", F.monotonically_increasing_id()), "ranked").withColumn(
        "part", F.expr("CAST(shiftright(id, 33) AS INT)")
    )
    sizes = placed.groupBy(*groups, "part").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    # One row per group and partition.
    earlier = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *groups, "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")
    )
    return placed.join(F.broadcast(starts), [*groups, "part"]).withColumn("idx", F.col("id") + F.col("shift"))


def indexed_categories(df: DataFrame, column: str) -> DataFrame:
    """``(value, idx)`` in the same order."""
    return ranked_categories(df, [column]).select("value", "idx")


def bucket_counts(df: DataFrame, column: str, width: int = 1000) -> DataFrame:
    """Rows per bucket of ``width``: a report on how skewed such a key would be.

    The value is cut to a whole number before and after the division, so the
    bucket around zero is twice as wide as the others.
    """
    bucket = F.expr(f"CAST(CAST({quoted(column)} AS BIGINT) / {width} AS BIGINT)")
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))


def mode_frequency(df: DataFrame, mode: str) -> DataFrame:
    """``(mode, count, rank)``: modes by descending number of rows, ties by mode.

    The ranking is a range-partitioned sort, so a column of any number of values will do.
    """
    counts = df.where(F.col(mode).isNotNull()).groupBy(F.col(mode).alias("mode")).count()
    ranked = _placed(counts.orderBy(F.desc("count"), F.asc("mode")), [])
    return ranked.select("mode", "count", F.col("idx").cast("int").alias("rank"))


def _per_column(df: DataFrame, columns: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """One aggregation over all columns, then one row per column."""
    wide = df.selectExpr(
        *(
            f"{fn}({quoted(c)}) AS {name}{i}"
            for i, c in enumerate(columns)
            for name, fn in measures.items()
        )
    )

    def cell(i: int, name: str) -> str:
        return f"CAST({name}{i} AS {'BIGINT' if name == 'count' else 'DOUBLE'})"

    rows = ", ".join(
        ", ".join([string(c), *(cell(i, name) for name in measures)]) for i, c in enumerate(columns)
    )
    names = ", ".join(quoted(n) for n in ("column", *measures))
    return wide.selectExpr(f"stack({len(columns)}, {rows}) AS ({names})")
