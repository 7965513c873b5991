"""Look values up in dictionaries of any size without moving the rows that are done."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeforge.functions.text import quoted

# Dictionaries that are broadcast whole have up to this many bytes of text and entries, all together.
BROADCAST_BYTES, ENTRY_BYTES = 64 << 20, 64
# Of each larger one so many of the most frequent entries, up to so long, are, and of all so many.
HOT, HOT_LENGTH, HOT_IN_ALL = 10_000, 256, 100_000
# Rows of one value that one task joins; a value that more rows lack is spread over several.
ROWS_A_PART = 500_000
# Bytes of a dictionary that one task holds.
PART_BYTES = 32 << 20
# Parts on a stream, whose rows can't be counted before.
STREAM_PARTS = 8


@dataclass(frozen=True)
class Dictionary:
    """``entries(value, idx)`` by descending frequency, and their measured size."""

    entries: DataFrame
    size: int
    text_bytes: int

    @property
    def bytes(self) -> int:
        return self.text_bytes + ENTRY_BYTES * self.size


@dataclass(frozen=True)
class Lookup:
    """Add ``name``: ``result`` of the entry whose ``match`` equals ``key``."""

    dictionary: Dictionary
    key: str
    match: str
    result: str
    name: str

    def entries(self, condition: str = "true") -> DataFrame:
        return self.dictionary.entries.where(condition).selectExpr(
            f"{self.match} AS __match", f"{self.result} AS {self.name}"
        )


def look_up(df: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """All lookups at once.

    The smallest dictionaries are broadcast, as many as stay within one bound together.  Of the others
    the frequent entries are, and the rows that still lack a value of any column, and only those, are
    joined with the rest by shuffle.
    """
    small = within_budget([x.dictionary for x in lookups])
    large = [x for x, fits in zip(lookups, small) if not fits]
    hot = hot_entries(len(large))
    for x in lookups:
        entries = x.entries(hot if x in large else "true")
        df = df.join(F.broadcast(entries), F.expr(x.key) == F.col("__match"), "left").drop("__match")
    if not large:
        return df
    pending = [f"({x.name} IS NULL AND ({x.key}) IS NOT NULL)" for x in large]
    some = " OR ".join(pending)
    done, rest = df.where(f"NOT ({some})"), df.where(some)
    counted = [None if df.isStreaming else _crowded(rest, x) for x in large]
    for x, crowded in zip(large, counted):
        rest = _joined(rest, x, hot, crowded)
    return done.unionByName(rest)


def within_budget(dictionaries: Sequence[Dictionary]) -> list[bool]:
    """Which of them are broadcast whole: the smallest, up to the bound of all."""
    fits = [False] * len(dictionaries)
    left = BROADCAST_BYTES
    for i in sorted(range(len(dictionaries)), key=lambda i: dictionaries[i].bytes):
        left -= dictionaries[i].bytes
        fits[i] = left >= 0
    return fits


def hot_entries(large: int) -> str:
    """Condition on the entries of each of so many large dictionaries that are broadcast."""
    return f"idx < {min(HOT, HOT_IN_ALL // max(1, large))} AND octet_length(value) <= {HOT_LENGTH}"


def _key(x: Lookup) -> str:
    """The key of the rows that still lack an entry."""
    return f"CASE WHEN {x.name} IS NULL THEN {x.key} END"


def _crowded(rows: DataFrame, x: Lookup) -> DataFrame:
    """``__hash, __parts`` of the keys that many rows lack: one row for ``ROWS_A_PART`` rows at the most, 12 bytes each."""
    hashed = rows.selectExpr(f"{_key(x)} AS __key").where("__key IS NOT NULL").groupBy(F.xxhash64("__key").alias("__hash"))
    return (
        hashed.agg(F.count("*").alias("n"))
        .where(F.col("n") > ROWS_A_PART)
        .select("__hash", F.ceil(F.col("n") / ROWS_A_PART).cast("int").alias("__parts"))
    )


def _joined(rows: DataFrame, x: Lookup, hot: str, crowded: DataFrame | None) -> DataFrame:
    """The shuffle join; a value that is not among the hot entries may be frequent all the same, so its
    rows, counted by hashes, are dealt over as many parts as they need.

    Rows stream past the entries of their part, so a task holds a bounded piece of the dictionary and no
    rows.  Sizes are those measured: long entries that compress well look small to the planner, which
    would broadcast them.
    """
    kept = [quoted(c) for c in rows.columns if c != x.name]
    keyed = rows.selectExpr("*", f"{_key(x)} AS __key")
    rare = x.entries(f"NOT ({hot})").withColumnRenamed(x.name, "__rare")
    if crowded is None:
        parts = F.lit(STREAM_PARTS)
    else:
        keyed = keyed.withColumn("__hash", F.xxhash64("__key")).join(F.broadcast(crowded), "__hash", "left")
        rare = rare.withColumn("__hash", F.xxhash64("__match")).join(F.broadcast(crowded), "__hash", "left")
        parts = F.coalesce("__parts", F.lit(1))
    # The part follows from the row, so a repeated task deals the same. Rows without a key match nothing
    # and go anywhere.
    salt = F.xxhash64(*(F.col(quoted(f.name)) for f in rows.schema.fields if f.name != x.name and f.dataType.typeName() != "map"))
    dealt = keyed.withColumn("__part", F.pmod(salt, F.when(F.col("__key").isNull(), F.lit(1 << 20)).otherwise(parts)).cast("int"))
    rare = rare.select("__match", "__rare", F.explode(F.sequence(F.lit(0), parts - 1)).alias("__other"))
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(x.dictionary.bytes / PART_BYTES))
    dealt = dealt.repartition(tasks, "__key", "__part")
    rare = rare.repartition(tasks, "__match", "__other").hint("shuffle_hash")
    return dealt.join(
        rare, (F.col("__key") == F.col("__match")) & (F.col("__part") == F.col("__other")), "left"
    ).selectExpr(*kept, f"coalesce({x.name}, __rare) AS {x.name}")
