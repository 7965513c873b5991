"""End-to-end jobs: inflate a CSV, and encode a column with validation."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from modeforge.config import MixtureConfig
from modeforge.functions.text import quoted
from modeforge.operators.codec import ModeEncoder
from modeforge.operators.fit import fit_mixture
from modeforge.operators.generate import inflate
from modeforge.operators.metrics import Measurement, MetricsLog, measurement
from modeforge.operators.profile import describe_columns
from modeforge.operators.validate import THRESHOLD, Validation, validate_columns
from modeforge.sources.files import (
    WriteReport,
    read_csv,
    read_parquet,
    write_checked,
)

RAW = "__raw"


@dataclass(frozen=True)
class GenerationResult:
    written: WriteReport
    statistics: DataFrame


def generation_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    target: int = 1_000_000,
    column: str = "Amount",
    schema: StructType | str | None = None,
    contents: bool = False,
    **options,
) -> GenerationResult:
    """Read a CSV, inflate one column to the target, write, count, describe.

    ``contents`` compares the rows that are read back with those written, by checksum.
    """
    source = read_csv(spark, input_path, schema)
    written = write_checked(inflate(source, column, target, **options), output_path, contents=contents)
    return GenerationResult(written, describe_columns(read_parquet(spark, output_path), [column]))


@dataclass(frozen=True)
class EncodeResult:
    encoder: ModeEncoder
    written: WriteReport
    validation: Validation
    measurement: Measurement


def encode_job(
    spark: SparkSession,
    source: str | DataFrame,
    output_path: str,
    column: str = "Amount",
    *,
    key: str | Sequence[str] | None = None,
    config: MixtureConfig | None = None,
    lossless: bool = False,
    threshold: float = THRESHOLD,
    relative: bool = False,
    contents: bool = False,
    portable: bool = False,
    log: MetricsLog | None = None,
) -> EncodeResult:
    """Fit a column, encode all rows, write them, and check what was written.

    The encoded rows keep their other columns and the raw value, so the check
    compares a row with itself, and it sees exactly what a reader of the output
    will see.
    The measured time includes the write.  ``contents`` compares the rows that are
    read back with those written, by checksum.
    """
    started = time.monotonic()
    df = read_parquet(spark, source) if isinstance(source, str) else source
    config = config or MixtureConfig()
    mixture = fit_mixture(df.select(quoted(column)), column, config)
    encoder = ModeEncoder(column, mixture, config)
    coded = encoder.encode(df, key, lossless=lossless, portable=portable)
    written = write_checked(coded, output_path, contents=contents)
    kept = read_parquet(spark, output_path)
    raw = kept.withColumnRenamed(column, RAW)
    checked = encoder.decode(raw, keep_input=True).select(RAW, quoted(column))
    validation = validate_columns(checked, RAW, column, threshold, relative)
    done = measurement(written.rows, time.monotonic() - started, validation.accuracy)
    if log is not None:
        log.add(done)
    return EncodeResult(encoder, written, validation, done)
