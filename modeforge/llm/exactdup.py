"""Exact duplicates: group by a 128-bit content hash, compare bytes inside the groups.

Texts are equal when they are identical after deleting white space ``[\\x20\\x09-\\x0D]``. DataFrame
functions only. Small rows of fingerprints are grouped first, so a group of any size is summed
before the shuffle. Whole texts are shuffled only where a hash occurs more than once, and there
again merged with their copies before they leave the task.

Defined cases: a null text counts as empty; a null id loses ties against any other; rows that agree
in id and text are copies of each other and exactly one of them stays; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeforge.llm.common import BLANK, broadcast_if_bounded, packed_row, row_digest, staged, text_or_empty, without_rows


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(text.cast("binary")))


def check_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def marked_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hash_of: Callable[[Column], Column] = content_hash,
    check_of: Callable[[Column], Column] = check_hash,
    key: Column | None = None,
) -> DataFrame:
    """``key, doc_id, keep_id, group_size, kept, text_sha256`` for every row; ``key`` is of the caller.

    Rows are numbered in the tables written here; no number is looked up in another scan. Of equal texts
    the row with the most code points in the original text stays, then that with the smallest id.
    ``hash_of`` and ``check_of`` can be weakened to test collisions.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        (F.lit(None).cast("binary") if key is None else key).alias("key"),
        F.col(id_col).alias("doc_id"),
        text_or_empty(text_col).alias("text"),
    ).select("row", "key", "doc_id", F.char_length("text").alias("points"), F.regexp_replace("text", BLANK + "+", "").alias("plain"))
    marked = rows.withColumn("h", hash_of(F.col("plain")))
    facts = [
        "row", "key", "doc_id", "points", "h", check_of(F.col("plain")).alias("c"), F.sha2(F.col("plain").cast("binary"), 256).alias("text_sha256")
    ]
    prints = staged(marked.select(*facts), "fingerprints")
    shared = staged(
        prints.groupBy("h").agg(F.count("*").alias("n"), F.count_distinct("c").alias("checks")).where("n > 1"),
        "shared-hashes",
    )
    # Byte comparison: grouping by hash and text compares the texts themselves.
    within = marked.join(broadcast_if_bounded(shared.select("h")), "h", "left_semi")
    by_bytes = within.groupBy("h", "plain").agg(F.min("row").alias("part")).select("h", "part")
    unequal = staged(
        by_bytes.groupBy("h")
        .agg(F.count("*").alias("texts"))
        .join(shared.select("h", "checks"), "h")
        .where("texts != checks")
        .select("h"),
        "collisions",
    )
    if unequal.isEmpty():
        keyed = prints.withColumn("part", F.lit(None).cast("bigint"))
    else:
        clashing = staged(marked.join(broadcast_if_bounded(unequal), "h", "left_semi").select(*facts, "plain"), "clashing")
        parts = clashing.groupBy("h", "plain").agg(F.min("row").alias("part"))
        others = prints.join(broadcast_if_bounded(unequal), "h", "left_anti").withColumn("part", F.lit(None).cast("bigint"))
        keyed = others.unionByName(staged(clashing.join(parts, ["h", "plain"]).drop("plain"), "parts"))
    by = ["h", "c", "part"]
    best = F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = staged(
        keyed.groupBy(*by).agg(F.count("*").alias("group_size"), best.alias("best")).select(
            *by, "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")
        ),
        "groups",
    )
    left, right = keyed.alias("l"), groups.alias("r")
    same = (F.col("l.h") == F.col("r.h")) & (F.col("l.c") == F.col("r.c")) & F.col("l.part").eqNullSafe(F.col("r.part"))
    return left.join(right, same).select(
        "l.key", "l.doc_id", "r.keep_id", "r.group_size", (F.col("l.row") == F.col("r.keep_row")).alias("kept"), "l.text_sha256"
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **hashes: Callable[[Column], Column]) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    return marked_rows(docs, id_col, text_col, **hashes).drop("key")


def unique_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; only digests of rows are joined back."""
    found = marked_rows(docs, id_col, text_col, key=row_digest(packed_row(docs), docs))
    return without_rows(docs, found.groupBy("key").agg(F.max("kept").alias("kept"), F.count("*").alias("copies")))
