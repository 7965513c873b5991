"""Time, throughput and accuracy of finished jobs, kept as a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The names of the result columns.
SCHEMA = "processing_time double, memory_usage double, accuracy double, throughput double"
AVERAGED = ("processing_time", "accuracy", "throughput")


@dataclass(frozen=True)
class Measurement:
    """Memory is null: a cluster has no one process to ask."""

    processing_time: float
    memory_usage: float | None
    accuracy: float
    throughput: float


def measurement(rows: int, seconds: float, accuracy: float) -> Measurement:
    """From the rows that a write has counted and the time up to its end."""
    return Measurement(seconds, None, accuracy, rows / seconds if seconds > 0 else 0.0)


@dataclass
class MetricsLog:
    """The measurements of several jobs."""

    measurements: list[Measurement] = field(default_factory=list)

    def add(self, done: Measurement) -> Measurement:
        self.measurements.append(done)
        return done

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([astuple(m) for m in self.measurements], SCHEMA)

    def summary(self, spark: SparkSession) -> DataFrame:
        return average_metrics(self.table(spark))


def average_metrics(df: DataFrame, columns: Sequence[str] = AVERAGED) -> DataFrame:
    """Mean of every column, 0 where there is nothing to average."""
    return df.agg(*(F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in columns))
