"""N-gram Jaccard join by vertical partitioning.

A global order of all shingles puts rare ones first: by the power of two of their number of documents,
then by hash. The order is cut into fragments, and with it every document's set into segments. Two
sets of Jaccard similarity 0.8 share a shingle among the first fifth of both, so these prefixes name
the pairs to look at; the overlap of a pair is counted fragment by fragment and summed.

Work follows the input, not the square of a group:

- Equal sets are one class from the start.
- Frequent shingles, such as those of passages that many documents share, are last in the order.
- Shingles of one document only can match nothing; a bitmap of fixed size finds nearly all of them,
  and only the others leave the task that reads the text.
- A set can overlap another no more than by its shingles that any other document has; pairs that this
  bound rules out are not looked at.
- Where many classes share a prefix shingle, bitmaps of 1024 bits bound the difference of two sets from
  below and rule out pairs of other components before they leave the join.
- Two sets that link share not one shingle of their prefixes but ``l`` of them, the more the closer their sizes
  (``_least_common``). So a set that has ``s`` shingles in common with other prefixes finds all its links under any
  ``s - l + 1`` of them, and the least crowded ones are taken. A copy with many changes has those in
  front, as they are rare, and never asks for the shingles that its whole group has.
- Links are wanted for components. First every class is compared with few others under each prefix
  shingle: the one with the fewest shingles of its own, and the same in a random part of some 16. Copies
  of one text differ by the changes of both, so the least changed link with nearly all that link at
  all, and groups are connected with work in proportion to their size. Then every class looks, under its least
  crowded shingles, for classes of larger components (of equal ones: the one with the larger root). Crowded
  shingles are cut by the sizes of sets, and only sizes at which enough shingles are left are looked
  at. No two classes in different components stay uncompared, so the components are exact.

The bitmap and the list of frequent shingles, both of fixed greatest size, are all that is broadcast;
any order is a right one, so their limits change the work, not the result. Shingles are 64-bit hashes.

Defined cases: a null or blank text has no shingles and is linked with nothing; a text of fewer words
is one shingle; components that do not settle in 60 rounds, which shorten paths by a factor each, are an
error; repeated rows are in one component; a null id is no component's name, and a component
without any id has a null one; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modeforge.llm.common import broadcast_if_bounded, chunks, components, packed_row, row_digest, small_batches, staged, without_rows
from modeforge.llm.shingles import shingle_sets

WIDTH = 5
#: Link when 100 * intersection >= 80 * union.
PERCENT = 80
FRAGMENTS = 8
#: The bitmap has this many bits, as a power of two: 16 MB.
SEEN_BITS = 27
#: Frequent shingles in the list at the most: 18 MB.
FREQUENT = 2_000_000
#: The list has shingles of at least 2**3 documents, or of more if there are too many.
LEAST_LEVEL = 3
#: Shingles a task gathers before it counts them, and bytes of text it makes into sets at a time. Python workers are used
#: again and keep what they once needed, so both count for all that an executor does later.
BUFFER = 1_000_000
TEXT_BYTES = 1 << 20
#: Classes of a random part of those under one shingle.
PART = 16
#: 64-bit words of the bitmap of a set.
SKETCH = 16
#: Sizes of sets in a band differ by this factor at the most.
BAND = 1.06


def _bits(documents: int) -> int:
    """Ranges of the hash as a power of two: some 4000 documents a range."""
    return min(20, max(4, math.ceil(math.log2(max(1, documents) / 4000))))


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        texts = batch.column("text")
        for first, part in chunks((t.as_py().encode() if t.is_valid else b"" for t in texts), TEXT_BYTES):
            yield batch.slice(first, len(part)), shingle_sets(part, WIDTH)


def _count_parts(bits: int):
    """Map side of the count: per range, the shingles met once and those met more often, with counts."""

    def emit(held: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(held)
        held.clear()
        every.sort()
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        values, counts = every[first], np.diff(first, append=len(every)).astype(np.uint32)
        del every, first
        begins = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        cuts = np.append(np.searchsorted(values, begins), len(values))
        # The 32 bits after those of the range.
        keys = (values >> np.uint64(32 - bits)).astype(np.uint32)
        del values
        rows = {"range": [], "ones": [], "more": [], "counts": []}
        for r in np.flatnonzero(np.diff(cuts)).tolist():
            k, c = keys[cuts[r] : cuts[r + 1]], counts[cuts[r] : cuts[r + 1]]
            rows["range"].append(r)
            rows["ones"].append(k[c == 1].tobytes())
            rows["more"].append(k[c > 1].tobytes())
            rows["counts"].append(c[c > 1].tobytes())
        return pa.RecordBatch.from_pydict(
            rows, pa.schema([("range", pa.int32()), ("ones", pa.binary()), ("more", pa.binary()), ("counts", pa.binary())])
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, sets in _text_batches(batches):
            held += sets
            size += sum(map(len, sets))
            if size >= BUFFER:
                yield emit(held)
                held, size = [], 0
        if size:
            yield emit(held)

    return count


def _sum_parts(bits: int):
    """Reduce side: per range a slice of the bitmap (level -1) and the frequent keys of each level, compressed."""

    def total(parts: pd.DataFrame) -> pd.DataFrame:
        r = int(parts["range"].iloc[0])
        ones = np.frombuffer(b"".join(parts["ones"]), np.uint32)
        more = np.frombuffer(b"".join(parts["more"]), np.uint32)
        counts = np.frombuffer(b"".join(parts["counts"]), np.uint32).astype(np.int64)
        keys = np.concatenate([ones, more])
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], np.concatenate([np.ones(len(ones), np.int64), counts])[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sums, keys = np.add.reduceat(weights, first), keys[first]
        seen = np.zeros(1 << (SEEN_BITS - bits), bool)
        seen[keys[sums > 1] >> np.uint32(32 - (SEEN_BITS - bits))] = True
        rows = [(r, -1, 0, zlib.compress(np.packbits(seen, bitorder="little"), 1))]
        levels = np.floor(np.log2(sums)).astype(np.int64)
        for level in np.unique(levels[levels >= LEAST_LEVEL]).tolist():
            own = keys[levels == level]
            rows.append((r, level, len(own), zlib.compress(own, 1)))
        return pd.DataFrame(rows, columns=["range", "level", "n", "keys"])

    return total


class Order:
    """What tasks need of the global order: the bitmap and the frequent shingles with their level."""

    def __init__(self, bits: int, rows: list) -> None:
        self.bits = bits
        size = 1 << (SEEN_BITS - bits - 3)
        self.seen = np.zeros(size << bits, np.uint8)
        keys, levels = [], []
        for r in rows:
            values = zlib.decompress(r["keys"])
            if r["level"] < 0:
                self.seen[r["range"] * size : (r["range"] + 1) * size] = np.frombuffer(values, np.uint8)
            else:
                own = np.frombuffer(values, np.uint32).astype(np.uint64)
                keys.append(own | (np.uint64(r["range"]) << np.uint64(32)))
                levels.append(np.full(len(own), r["level"], np.uint8))
        joined = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(joined)
        self.keys, self.levels = joined[order], (np.concatenate(levels) if levels else np.zeros(0, np.uint8))[order]

    def marks(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether more than one document may have each shingle, and its level (0: not frequent)."""
        at = (values >> np.uint64(64 - SEEN_BITS)).astype(np.int64)
        shared = (self.seen[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        level = np.zeros(len(values), np.uint8)
        if len(self.keys):
            some = np.flatnonzero(shared)
            own = values[some] >> np.uint64(32 - self.bits)
            place = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            level[some] = np.where(self.keys[place] == own, self.levels[place], 0)
        return shared, level


def _needed(n: int) -> int:
    """The smallest overlap with a set of at least 80 % of its size: ceil(0.8 n)."""
    return -(-PERCENT * n // 100)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(offsets, values)


def _sketches(sets: list[np.ndarray]) -> pa.ListArray:
    """Per set, which of 1024 hash values its shingles have."""
    bits = np.zeros((len(sets), 64 * SKETCH), bool)
    for row, own in zip(bits, sets, strict=True):
        row[(own & np.uint64(64 * SKETCH - 1)).astype(np.int64)] = True
    words = np.packbits(bits, axis=1, bitorder="little").view(np.int64).reshape(-1)
    return pa.ListArray.from_arrays(np.arange(0, len(words) + 1, SKETCH, dtype=np.int32), words)


def _ordered(shared_order):
    """Per document: size and digest of its set, and of the shared shingles prefix and segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared_order.value
        for batch, sets in _text_batches(batches):
            digests, prefixes, segments, common = [], [], [], []
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
            shared, level = order.marks(flat)
            start = 0
            for own in sets:
                n = len(own)
                s, lv = shared[start : start + n], level[start : start + n]
                start += n
                common.append(int(s.sum()))
                digests.append(hashlib.md5(own.tobytes()).digest() if n else None)
                rank = np.concatenate([np.flatnonzero(lv == 0), (often := np.flatnonzero(lv > 0))[np.argsort(lv[often], kind="stable")]])
                head = rank[: n - _needed(n) + 1] if n else rank
                prefixes.append(own[head[s[head]]])
                # The last fragment has the frequent shingles, the others equal ranges of the rest.
                rare = own[s & (lv == 0)]
                cuts = np.searchsorted(rare, np.array([(k << 64) // (FRAGMENTS - 1) for k in range(1, FRAGMENTS - 1)], np.uint64))
                segments += [*np.split(rare, cuts), own[s & (lv > 0)]]
            inner = _lists(segments)
            outer = pa.ListArray.from_arrays(np.arange(0, len(segments) + 1, FRAGMENTS, dtype=np.int32), inner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(common, pa.int64()), pa.array(digests, pa.binary()), _sketches(sets), _lists(prefixes), outer],
                ["key", "doc_id", "n", "common", "digest", "sketch", "prefix", "segments"],
            )

    return run


def _may_link(x: Column, y: Column) -> Column:
    """Whether the overlap of two sets can be large enough, by what each shares with any other."""
    most = F.least(x["common"], y["common"])
    return 100 * most >= PERCENT * (x["n"] + y["n"] - most)


def _may_be_close(x: Column, y: Column, one: Column, two: Column) -> Column:
    """Whether the difference of two sets can be small enough, by the bits in which bitmaps differ."""
    bits = F.lit(0)
    for i in range(SKETCH):
        bits = bits + F.bit_count(one[i].bitwiseXOR(two[i]))
    return F.coalesce((100 + PERCENT) * bits <= (100 - PERCENT) * (x["n"] + y["n"]), F.lit(True))


def _least_common(x: Column, y: Column) -> Column:
    """How many shingles the prefixes of two sets that link have in common, at the least.

    With an overlap of ``a`` at the least, prefixes of ``n - a + l`` shingles share ``l``; the prefixes taken here
    have ``n - ceil(0.8 n) + 1``.
    """
    overlap = F.ceil(PERCENT * (x["n"] + y["n"]) / (100 + PERCENT))
    return overlap + 1 - F.ceil(PERCENT * F.greatest(x["n"], y["n"]) / 100)


def _band(n: Column) -> Column:
    return F.floor(F.log(n) / F.log(F.lit(BAND))).cast("int")


def _bands_to_ask(n: Column, slack: Column) -> Column:
    """Bands with sizes at which a set may link and ``_least_common`` may be as low as ``slack``.

    Between two sizes the number is no lower than at one of them; one is taken off for rounding.
    """

    def least(size: Column) -> Column:
        return PERCENT * (n + size) / (100 + PERCENT) - PERCENT * F.greatest(n, size) / 100 - 1

    every = F.sequence(_band(n * PERCENT / 100) - 1, _band(n * 100 / PERCENT) + 1)
    return F.filter(every, lambda b: F.least(least(F.pow(F.lit(BAND), b)), least(F.pow(F.lit(BAND), b + 1))) <= slack)


def _pairs(frame: DataFrame) -> DataFrame:
    """Distinct pairs ``a < b`` of the classes ``x`` and ``y`` that may link."""
    x, y = F.col("x"), F.col("y")
    return (
        frame.where((x["cid"] != y["cid"]) & _may_link(x, y))
        .select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b"), (x["n"] + y["n"]).alias("both"))
        .distinct()
    )


def overlapping(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The pairs that link: overlaps counted by fragment, summed per pair."""
    own = lambda side: segments.select(F.col("cid").alias(side), "fragment", F.col("segment").alias(f"s{side}"))
    # One row for each segment of ``a`` that isn't empty, then only those of which ``b`` has one too.
    partial = (
        pairs.join(own("a"), "a")
        .join(own("b"), ["b", "fragment"])
        .select("a", "b", "both", F.size(F.array_intersect("sa", "sb")).alias("n"))
    )
    sums = partial.groupBy("a", "b", "both").agg(F.sum("n").alias("n"))
    return sums.where(100 * F.col("n") >= PERCENT * (F.col("both") - F.col("n"))).select("a", "b")


def _segments_of(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Segments of the classes in ``pairs``, one row for each that isn't empty."""
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct()
    named = staged(classes.select("cid", "digest").join(wanted, "cid", "left_semi"), "wanted")
    return staged(
        sets.select("digest", "segments")
        .join(broadcast_if_bounded(named), "digest")
        .dropDuplicates(["cid"])
        .select("cid", F.posexplode("segments").alias("fragment", "segment"))
        .where(F.size("segment") > 0),
        "segments",
    )


def _sets(rows: DataFrame, counted: DataFrame, bits: int) -> DataFrame:
    """What ``_ordered`` makes of every row. The order is the only large thing that the driver holds.

    Its rows come as Arrow batches, of which the JVM makes no objects and no pickles, several times their size, and
    they and their broadcast go when the sets are written: heap that the driver once needed stays with it.
    """
    levels = {r["level"]: r["n"] for r in counted.where("level >= 0").groupBy("level").agg(F.sum("n").alias("n")).collect()}
    least = min((lv for lv in levels if sum(n for k, n in levels.items() if k >= lv) <= FREQUENT), default=99)
    parts = counted.where((F.col("level") < 0) | (F.col("level") >= least))
    order = rows.sparkSession.sparkContext.broadcast(Order(bits, parts.toArrow().to_pylist()))
    kind = f"key binary, doc_id {dict(rows.dtypes)['doc_id']}, n long, common long, digest binary, sketch array<long>, prefix array<long>, segments array<array<long>>"
    with small_batches(rows.sparkSession):
        sets = staged(rows.mapInArrow(_ordered(order), kind), "sets")
    order.destroy()
    return sets


def _grouped(rows: DataFrame) -> DataFrame:
    """``key, doc_id, n, root, component_id`` for every row of ``rows(key, doc_id, text)``.

    ``root`` is the class that stands for the component, also where no member has an id or two
    components share one; it is null for rows without shingles.
    """
    spark = rows.sparkSession
    bits = _bits(rows.count())
    with small_batches(spark):
        counted = staged(
            rows.select("text")
            .mapInArrow(_count_parts(bits), "range int, ones binary, more binary, counts binary")
            .groupBy("range")
            .applyInPandas(_sum_parts(bits), "range int, level int, n long, keys binary"),
            "shingle-counts",
        )
    sets = _sets(rows, counted, bits)
    classes = staged(
        sets.where("n > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), *(F.first(c).alias(c) for c in ("n", "common", "sketch", "prefix")))
        .select(F.monotonically_increasing_id().alias("cid"), "digest", "first_id", "n", "common", "sketch", "prefix"),
        "classes",
    )

    # A class as its neighbours see it; the order puts sets with few shingles of their own first.
    facts = F.struct(((F.col("n") - F.col("common")) / F.col("n")).alias("own"), "cid", "n", "common")
    under = staged(classes.select(F.explode("prefix").alias("shingle"), facts.alias("x")), "prefixes")
    several = staged(under.groupBy("shingle").agg(F.count("*").alias("many"), F.min("x").alias("y")).where("many > 1"), "buckets")
    under = staged(
        under.join(several, "shingle").select(
            "shingle", "x", "y", "many", F.when(F.col("many") > PART, F.pmod(F.xxhash64("x.cid", "shingle"), F.ceil(F.col("many") / PART))).alias("part")
        ),
        "members",
    )
    leaders = under.where("part is not null").groupBy("shingle", "part").agg(F.min("x").alias("y"))
    with_leader = under.select("shingle", "part", "x").join(leaders, ["shingle", "part"])
    tried = staged(_pairs(under.select("x", "y").unionByName(with_leader.select("x", "y"))), "first-pairs")
    links = staged(overlapping(tried, _segments_of(tried, classes, sets)), "first-links")
    known = components(links)
    known = staged(known.join(known.groupBy("root").agg(F.count("*").alias("size")), "root"), "first-components")

    # What different components still have in common. ``slack`` is the number of the class's shingles that are
    # at least as crowded as this one: it is asked for sets that share no more than so many with the class.
    rank = Window.partitionBy("x.cid").orderBy(F.col("many").desc(), "shingle")
    inside = staged(
        under.select("shingle", "part", "x", F.row_number().over(rank).alias("slack"), F.col("x.cid").alias("node"))
        .join(known, "node", "left")
        .select("shingle", "part", "x", "slack", F.struct(F.coalesce("size", F.lit(1)).alias("size"), F.coalesce("root", "node").alias("root")).alias("of")),
        "members-by-component",
    )
    mixed = staged(
        inside.groupBy("shingle").agg(F.min("of").alias("least"), F.max("of").alias("main")).where("least <> main").select("shingle", "main"),
        "mixed-buckets",
    )
    inside = staged(inside.join(mixed, "shingle"), "mixed-members")
    crowded = F.col("part").isNotNull()
    size = F.col("x.n")
    one = inside.where("of <> main").select(
        "shingle", F.explode(F.when(crowded, _bands_to_ask(size, F.col("slack"))).otherwise(F.array(F.lit(-1)))).alias("band"),
        "x", "slack", F.col("of").alias("rx"), crowded.alias("crowded"),
    )
    two = inside.select("shingle", F.when(crowded, _band(size)).otherwise(-1).alias("band"), F.col("x").alias("y"), F.col("of").alias("ry"), crowded.alias("crowded"))
    # Bitmaps are brought only to rows that can meet, and only where buckets are crowded.
    asked = staged(one.where("crowded").select("shingle", "band").distinct(), "asked-bands")
    sketches = classes.select("cid", "sketch")
    no_sketch = F.lit(None).cast("array<bigint>")

    def sketched(rows: DataFrame, member: str, name: str) -> DataFrame:
        far = rows.where("crowded").join(sketches, F.col(f"{member}.cid") == F.col("cid")).withColumnRenamed("sketch", name).drop("cid")
        return rows.where("NOT crowded").withColumn(name, no_sketch).unionByName(far).drop("crowded")

    two = two.where("NOT crowded").unionByName(two.where("crowded").join(asked, ["shingle", "band"]).select(two.columns))
    one, two = sketched(one, "x", "one"), sketched(two, "y", "two")
    across = one.join(two, ["shingle", "band"]).where(
        (F.col("rx") < F.col("ry"))
        & _may_link(F.col("x"), F.col("y"))
        & (_least_common(F.col("x"), F.col("y")) <= F.col("slack"))
        & _may_be_close(F.col("x"), F.col("y"), F.col("one"), F.col("two"))
    )
    rest = staged(staged(_pairs(across), "met-pairs").join(tried, ["a", "b"], "left_anti"), "second-pairs")
    more = staged(overlapping(rest, _segments_of(rest, classes, sets)), "second-links")
    joined = components(links.unionByName(more))

    named = classes.join(joined.withColumnRenamed("node", "cid"), "cid", "left").select("digest", "first_id", F.coalesce("root", "cid").alias("root"))
    roots = staged(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "roots")
    final = staged(named.join(roots, "root").select("digest", "root", "component_id"), "components")
    return sets.select("key", "doc_id", "n", "digest").join(final, "digest", "left").select(
        "key", "doc_id", "n", "root", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row."""
    rows = docs.select(F.lit(None).cast("binary").alias("key"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _grouped(rows).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component one row with its smallest id stays.

    Components are told apart by their texts, not by their ids, so ids may be null or repeated. Rows are
    found again by a digest of their content. Rows without shingles all stay.
    """
    row = packed_row(docs)
    rows = docs.select(row_digest(row, docs).alias("key"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # Repeated rows are one entry before components meet.
    entries = staged(_grouped(rows).where("n > 0").groupBy("key", "doc_id", "root").agg(F.count("*").alias("copies")), "entries")
    best = entries.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("best"))
    kept = staged(best.select("best.key", F.lit(True).alias("kept")), "kept-keys")
    return without_rows(docs, entries.join(kept, "key", "left").select("key", F.coalesce("kept", F.lit(False)).alias("kept"), "copies"))
