"""Sharding: a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child gets a draw ``-ln(u) / weight``
from a hash of the row's key and the child's path; the smallest wins (weighted rendezvous). A child
whose weight grows only lowers its own draw, so rows move only into subtrees whose weight grew and,
below them, only into children whose weight grew. A shard added as a region of its own takes rows
only into itself. DataFrame functions only.

Slots follow a hash of key and text, so rows of one id, or without any, are spread as others are; rows that
agree in id and text are counted first and numbered as one, whatever their number.

Defined cases: a null key hashes as empty text; a null text has size 1 and crc32 0; equal keys share
a shard and take slots of their own; an empty table gives an empty result; only key and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import pairwise
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modeforge.llm.common import broadcast_if_bounded, staged, text_or_empty, unit_draw


#: Equal rows that one task numbers and writes.
AT_ONCE = 100_000


class Leaf(NamedTuple):
    """A shard and its place; weights of racks and regions are sums over their shards."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0


def regular_tree(shards: int = 16, racks: int = 2, per_rack: int = 4) -> list[Leaf]:
    """Shards 0, 1, ... in regions of ``racks`` x ``per_rack``."""
    per_region = racks * per_rack
    return [Leaf(f"region{s // per_region}", f"rack{s % per_region // per_rack}", s) for s in range(shards)]


def with_one_more(tree: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard in a region of its own, so that no other subtree changes."""
    shard = max(leaf.shard for leaf in tree) + 1
    return [*tree, Leaf(f"grown{shard}", "rack0", shard, weight)]


def _children(tree: Sequence[Leaf]) -> tuple[dict[str, dict[str, float]], dict[str, int]]:
    """The children of every inner node with their weights, and the shard of every leaf."""
    if not tree or any(leaf.weight <= 0 for leaf in tree) or len({leaf.shard for leaf in tree}) < len(tree):
        raise ValueError("a tree has shards of their own number, of positive weight")
    kids: dict[str, dict[str, float]] = {}
    shards: dict[str, int] = {}
    for leaf in tree:
        path = ["", leaf.region, f"{leaf.region}/{leaf.rack}", f"{leaf.region}/{leaf.rack}/{leaf.shard}"]
        for parent, child in pairwise(path):
            under = kids.setdefault(parent, {})
            under[child] = under.get(child, 0.0) + leaf.weight
        shards[path[-1]] = leaf.shard
    return kids, shards


def shard_of(key: Column, tree: Sequence[Leaf]) -> Column:
    """The shard a key descends to; equal draws go to the first path."""
    kids, shards = _children(tree)
    options = F.create_map(
        *(
            item
            for parent, under in kids.items()
            for item in (
                F.lit(parent),
                F.array(*(F.struct(F.lit(c).alias("path"), F.lit(w).alias("weight")) for c, w in under.items())),
            )
        )
    )

    def draw(child: Column) -> Column:
        return F.struct((-F.log(unit_draw(key, child["path"])) / child["weight"]).alias("draw"), child["path"].alias("path"))

    node = F.lit("")
    for _ in range(3):
        node = F.array_min(F.transform(F.element_at(options, node), draw))["path"]
    numbers = F.create_map(*(F.lit(item) for pair in shards.items() for item in pair))
    return F.element_at(numbers, node)


def place(
    docs: DataFrame,
    tree: Sequence[Leaf] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int | None = None,
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    Slots number each shard's rows in the order of a hash of key and text. Both the numbered groups and
    the table of their offsets have about the square root of a shard's different rows.
    """
    tree = list(tree or regular_tree())
    rows = docs.count() if rows is None else rows
    pieces = max(1, math.isqrt(rows // len(tree)))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    text = text_or_empty(text_col)
    crc = F.crc32(text.cast("binary"))
    facts = ["doc_id", "size", "text_crc32", "shard", "grown_shard", "u"]
    equal = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        crc.alias("text_crc32"),
        shard_of(key, tree).cast("int").alias("shard"),
        shard_of(key, with_one_more(tree)).cast("int").alias("grown_shard"),
        unit_draw(F.concat(key, F.lit("|"), crc.cast("string")), "slot").alias("u"),
    ).groupBy(*facts).agg(F.count("*").alias("n"))
    equal = staged(equal.withColumn("piece", F.floor(F.col("u") * pieces).cast("int")), "places")
    counts = equal.groupBy("shard", "piece").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    order = Window.partitionBy("shard", "piece").orderBy("u", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("offset") + F.coalesce(F.sum("n").over(order), F.lit(0))
    placed = equal.join(broadcast_if_bounded(offsets, pieces * len(tree)), ["shard", "piece"]).withColumn("first", first)
    slots = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot")
    shown = ["doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slots, "grown_shard"]
    few = placed.where(F.col("n") <= AT_ONCE).select(*shown)
    if equal.where(F.col("n") > AT_ONCE).isEmpty():
        return few
    # Very many equal rows are written by several tasks.
    runs = placed.where(F.col("n") > AT_ONCE).withColumn("run", F.explode(F.expr(f"sequence(0L, (n - 1) div {AT_ONCE})")))
    runs = runs.withColumn("first", F.col("first") + F.col("run") * AT_ONCE).withColumn("n", F.least(F.lit(AT_ONCE), F.col("n") - F.col("run") * AT_ONCE))
    return few.unionByName(runs.repartition("shard", "piece", "run").select(*shown))
