"""Scans and sinks for CSV and parquet."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from modeforge.functions.text import quoted
from modeforge.functions.uniform import key_columns, keyed_uniform


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header line.  Without a schema the types are inferred, which
    costs one more pass over the files."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Parquet files, spread over ``partitions`` round robin when that is given."""
    df = spark.read.parquet(path)
    return df.repartition(partitions) if partitions else df


# Fixed value: part of the rows that a sample keeps.
SAMPLE_FRACTION = 0.1


def read_sample(
    spark: SparkSession,
    path: str,
    fraction: float = SAMPLE_FRACTION,
    key: str | Sequence[str] | None = None,
    seed: int = 42,
    portable: bool = False,
) -> DataFrame:
    """Each row kept with probability ``fraction``, without replacement."""
    return keep_fraction(read_parquet(spark, path), fraction, key, seed, portable)


def keep_fraction(
    df: DataFrame,
    fraction: float,
    key: str | Sequence[str] | None = None,
    seed: int = 42,
    portable: bool = False,
) -> DataFrame:
    """Bernoulli sample; with a key the same rows are kept on every evaluation.

    Without one a retried task may draw anew, so the result is no table to publish from twice.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    u = keyed_uniform(key_columns(key), seed, "sample", portable)
    return df.where(f"{u} < {fraction!r}D")


def take_sample(
    df: DataFrame,
    rows: int,
    key: str | Sequence[str],
    seed: int = 42,
    portable: bool = False,
) -> DataFrame:
    """Exactly ``rows`` rows (all, if there are fewer), the same ones every time.

    They are the smallest draws.  Rows are counted by slices of the draw, about as many slices as a
    slice has rows; whole slices are filtered, and only the one in which the sample ends is sorted.
    """
    names = key_columns(key)
    u = keyed_uniform(names, seed, "sample", portable)
    if rows <= 0:
        return df.limit(0)
    slices = max(1, math.isqrt(df.count()))
    slice_of = f"CAST(floor({u} * {slices}) AS BIGINT)"
    counts = df.groupBy(F.expr(slice_of).alias("slice")).agg(F.count("*").alias("n"))
    upto = counts.selectExpr("slice", "n", "sum(n) OVER (ORDER BY slice) AS upto")
    end = upto.where(F.col("upto") >= rows).orderBy("slice").first()
    if end is None:
        return df
    left = rows - (end["upto"] - end["n"])
    whole = df.where(f"{slice_of} < {end['slice']}")
    part = df.where(f"{slice_of} = {end['slice']}").orderBy(F.expr(u), *(F.expr(n) for n in names))
    return whole.unionAll(part.limit(left))


# Parts into which rows of one part of the input are dealt, which are longer once decompressed, and the fewest of all.
PARTS_FOR_ONE, FEWEST_PARTS = 4, 7


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


@dataclass(frozen=True)
class WriteReport:
    path: str
    rows: int
    rows_read_back: int
    seconds: float
    checksum: int | None = None
    checksum_read_back: int | None = None

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds > 0 else 0.0

    @property
    def complete(self) -> bool:
        """As many rows, and the same ones where contents were compared."""
        return self.rows == self.rows_read_back and self.checksum == self.checksum_read_back


def checksum(df: DataFrame) -> Column:
    """A sum over the rows that their order does not change and that any changed value does."""
    columns = [F.col(quoted(f.name)) if f.dataType.typeName() != "map" else F.to_json(F.col(quoted(f.name))) for f in df.schema.fields]
    # The number of the column goes with its value, so that nulls and swapped values count.
    marked = [x for i, c in enumerate(columns) for x in (F.when(c.isNull(), F.lit(-1 - i)).otherwise(F.lit(i)), c)]
    return F.coalesce(F.sum(F.xxhash64(*marked).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")


def dealt_anew(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The rows in another order, in several parts for each part of the input, so that none grows with the table."""
    parts = PARTS_FOR_ONE * df.rdd.getNumPartitions()
    return df.repartition(max(FEWEST_PARTS, parts), *map(quoted, [key] if isinstance(key, str) else key))


def write_checked(
    df: DataFrame, path: str, mode: str = "overwrite", contents: bool = False
) -> WriteReport:
    """Write parquet and confirm that as many rows can be read back.

    The rows are counted while they are written.  The read-back count selects
    no columns, so it only visits the row counts in the file footers.  With
    ``contents`` the rows written are summed up too and compared with all rows
    as they are read back.
    """
    if mode not in ("overwrite", "error", "errorifexists"):
        raise ValueError("the row count can be checked only for a freshly written folder")
    spark = df.sparkSession
    seen = Observation()
    started = time.monotonic()
    measures = [F.count(F.lit(1)).alias("rows"), *[checksum(df).alias("sum")] * contents]
    write_parquet(df.observe(seen, *measures), path, mode)
    seconds = time.monotonic() - started
    if not contents:
        return WriteReport(path, seen.get["rows"], spark.read.parquet(path).count(), seconds)
    rows, found = contents_of(spark, path)
    return WriteReport(path, seen.get["rows"], rows, seconds, int(seen.get["sum"]), found)


def contents_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and checksum of the rows of a folder."""
    written = spark.read.parquet(path)
    rows, found = written.agg(F.count(F.lit(1)), checksum(written)).first()
    return rows, int(found)
