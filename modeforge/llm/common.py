"""Helpers the operators share: tables, staging, bounded broadcasts, chunks of text, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, TimestampType

from modeforge.sources.scratch import scratch_path

#: Rows of a few dozen bytes that may be broadcast: some 25 MB at the most.
BROADCAST_ROWS = 250_000
#: Bytes of text that Python code handles at a time.
CHUNK_BYTES = 4 << 20
#: White space of the contracts, for Java regular expressions.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read from there: lost executors cost no second scan."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python tasks of what is written meanwhile get batches of ``CHUNK_BYTES``, which the JVM holds too; the default is 64 MB."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(CHUNK_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def broadcast_if_bounded(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Hint a broadcast when the counted rows are few; beyond that the join shuffles."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_crc(name: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as empty text, so it is never held out."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def unit_draw(key: Column, purpose: str | Column) -> Column:
    """A number inside (0, 1) from an md5 that any engine can repeat; 52 bits are exact doubles."""
    purpose = F.lit(purpose) if isinstance(purpose, str) else purpose
    digest = F.md5(F.concat(key, F.lit("|"), purpose).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def packed_row(docs: DataFrame) -> Column:
    """All columns of a row as one, whatever their names."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns))


def row_digest(row: Column, docs: DataFrame) -> Column:
    """128 bits of a ``packed_row`` of ``docs``: a name of its content that every scan gives alike."""
    parts = []
    for field in docs.schema.fields:
        value = row.getField(field.name)
        nested = isinstance(field.dataType, (ArrayType, MapType, StructType))
        if isinstance(field.dataType, TimestampType):
            value = F.unix_micros(value)  # a text would be that of the session's zone
        text = F.to_json(F.struct(value.alias("x"))) if nested else value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def without_rows(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that ``entries(key, kept, copies)`` drops, and one of each kept row.

    ``key`` is the ``row_digest``, so nothing depends on how a scan is cut. Rows without an entry all stay.
    Texts are shuffled only if the keys to drop are too many to broadcast, or of rows repeated as a whole.
    """
    named = docs.select(packed_row(docs).alias("_row")).withColumn("key", row_digest(F.col("_row"), docs))
    drop = staged(entries.where("NOT kept OR copies > 1").select("key", "kept"), "dropped-keys")
    out = named.join(broadcast_if_bounded(drop.select("key")), "key", "left_anti").select("_row")
    repeated = drop.where("kept").select("key")
    if not repeated.isEmpty():
        once = named.join(broadcast_if_bounded(repeated), "key", "left_semi").groupBy("key").agg(F.first("_row").alias("_row"))
        out = out.unionByName(once.select("_row"))
    return out.select("_row.*")


def chunks(texts: Iterable[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of some ``limit`` bytes, with the position of the first."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        if held and size + len(text) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of edges ``(a, b)``: rows ``(node, root)``, root the smallest node.

    Large-star and small-star steps in turn (Kiveris et al. 2014). Minima are aggregated before the
    shuffle, so a node with many edges gathers no list; every round is staged.
    """
    now = staged(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).where("u != v").distinct()
        large = staged(large, "large-star")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .distinct()
        )
        now = staged(small, "small-star")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
