"""Encode files as they arrive.

Encoding is a stateless projection, so a fitted encoder takes a streaming
DataFrame as it is: no watermark, no state, and with a row key the same draws
as in a batch job.  Categories of a table are looked up in its dictionaries, which
are static tables, so those too are joins without state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from modeforge.operators.codec import ModeEncoder
from modeforge.operators.table import TableEncoder


def read_files_as_stream(
    spark: SparkSession, folder: str, schema: StructType | str, pattern: str = "*.parquet"
) -> DataFrame:
    """Parquet files of a folder, new ones as they appear."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def encode_stream(
    stream: DataFrame,
    encoder: ModeEncoder,
    output_path: str,
    checkpoint_path: str,
    key: str | Sequence[str] | None = None,
    available_now: bool = True,
    **options,
) -> StreamingQuery:
    """Encode and append to parquet, exactly once per input file.

    ``available_now`` ends the query when all present files are done.
    """
    return _append(encoder.encode(stream, key, **options), output_path, checkpoint_path, available_now)


def encode_table_stream(
    stream: DataFrame,
    encoder: TableEncoder,
    output_path: str,
    checkpoint_path: str,
    key: str | Sequence[str] | None = None,
    available_now: bool = True,
    **options,
) -> StreamingQuery:
    """Encode the rows of a table and append to parquet, exactly once per input file.

    ``options`` are those of ``TableEncoder.transform``.
    """
    return _append(encoder.transform(stream, key, **options), output_path, checkpoint_path, available_now)


def decode_table_stream(
    stream: DataFrame,
    encoder: TableEncoder,
    output_path: str,
    checkpoint_path: str,
    keep: Sequence[str] = (),
    available_now: bool = True,
) -> StreamingQuery:
    """Decode encoded rows of a table and append to parquet, exactly once per input file."""
    return _append(encoder.inverse_transform(stream, keep), output_path, checkpoint_path, available_now)


def _append(
    rows: DataFrame, output_path: str, checkpoint_path: str, available_now: bool
) -> StreamingQuery:
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(output_path)
