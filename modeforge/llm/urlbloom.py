"""URL filters: a blocked Bloom filter of listed entries, then an exact hash join.

Entries are canonical URLs, and rules of a host and a path prefix. A page asks for its canonical URL
and for every pair of a domain suffix of its host and a prefix of its path that a rule could have.
The filter, blocks of 256 bits in which a key sets eight, passes possible hits; the join with the
entries removes false positives. DataFrame functions only. The filter is a table of blocks built by
``bit_or`` before the shuffle; it is broadcast while its size, known from the number of keys, is
bounded, and joined by shuffle beyond that. The same holds for the rules.

Defined cases: a null url, or one without ``://``, has an empty host and path and no canonical URL; a
rule without a path fits every path of its host; of rules of equal length the one with the longer
host, then the smaller text wins; repeated entries count once; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeforge.llm.common import ascii_lower, broadcast_if_bounded, staged

BITS_PER_KEY = 16
BLOCK_BITS = 256
PROBES = 8


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


#: The rules of the query.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a last slash, query parameters sorted, no tracking ones."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)")))
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    text = F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    return F.when(host != "", text)


def _masks(key: Column) -> list[Column]:
    """Four 64-bit words with the key's bits of its block."""
    bits = F.xxhash64(key, F.lit(1))
    at = [F.shiftrightunsigned(bits, 8 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PROBES)]
    words = []
    for w in range(BLOCK_BITS // 64):
        word = F.lit(0).cast("bigint")
        for slot in at:
            one = F.expr("1L")
            shifted = F.call_function("shiftleft", one, slot.bitwiseAND(F.lit(63)).cast("int"))
            word = word.bitwiseOR(F.when(F.shiftrightunsigned(slot, 6) == w, shifted).otherwise(F.lit(0).cast("bigint")))
        words.append(word.alias(f"m{w}"))
    return words


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter of column ``key``: ``block, w0 ... w3``."""
    return (
        keys.select(_block(F.col("key"), blocks), *_masks(F.col("key")))
        .groupBy("block")
        .agg(*(F.bit_or(f"m{w}").alias(f"w{w}") for w in range(BLOCK_BITS // 64)))
    )


def block_count(keys: int) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1, keys) * BITS_PER_KEY / BLOCK_BITS)))


def possible_hits(asked: DataFrame, filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``asked`` whose ``key`` may be in the filter."""
    marked = asked.select("*", _block(F.col("key"), blocks), *_masks(F.col("key")))
    hit = F.lit(True)
    for w in range(BLOCK_BITS // 64):
        hit = hit & (F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}"))
    return marked.join(broadcast_if_bounded(filter_blocks, blocks), "block").where(hit).select(asked.columns)


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` for every row of ``pages``.

    ``listed`` has a column ``url`` of URLs to block. The longest fitting rule decides; without one,
    listed URLs are blocked and others allowed.
    """
    spark = pages.sparkSession
    rows = staged(
        pages.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url")
        ).select("row", "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), canonical(F.col("url")).alias("canon")),
        "urls",
    )
    entries = listed.select(canonical(F.col("url")).alias("canon")).where("canon is not null").distinct()
    entries = staged(entries.select(F.concat(F.lit("u "), "canon").alias("key")), "entries")
    ruled = spark.createDataFrame(
        [(f"r {r.host} {r.path}", r.host + r.path, len(r.host), r.verdict) for r in rules], "key string, rule string, host_length int, verdict string"
    )
    blocks = block_count(entries.count() + len(rules))
    bloom = staged(bloom_blocks(entries.unionByName(ruled.select("key")), blocks), "bloom")

    # No rule has more labels or another path length than these, so nothing else needs asking.
    labels = max((r.host.count(".") + 1 for r in rules), default=0)
    lengths = sorted({len(r.path) for r in rules})
    suffixes = [F.when(F.size(F.split("host", r"\.", n + 1)) >= n, F.substring_index("host", ".", -n)) for n in range(1, labels + 1)]
    prefixes = [F.when(F.char_length("path") >= n, F.substring("path", 1, n)) for n in lengths]
    questions = [F.when(F.col("host") != "", F.concat(F.lit("r "), s, F.lit(" "), p)) for s in suffixes for p in prefixes]
    asked = rows.select("row", F.explode(F.array_distinct(F.filter(F.array(F.concat(F.lit("u "), "canon"), *questions), lambda q: q.isNotNull()))).alias("key"))
    maybe = staged(possible_hits(asked, bloom, blocks), "possible-hits")

    by_rule = (
        maybe.join(broadcast_if_bounded(ruled, len(rules)), "key")
        .groupBy("row")
        .agg(F.min(F.struct((-F.length("rule")).alias("a"), (-F.col("host_length")).alias("b"), "rule", "verdict")).alias("best"))
        .select("row", "best.rule", F.col("best.verdict").alias("said"))
    )
    by_list = maybe.where(F.col("key").startswith("u ")).join(entries, "key", "left_semi").select("row", F.lit(True).alias("on_list"))
    return (
        rows.join(by_rule, "row", "left")
        .join(by_list, "row", "left")
        .select(
            "page_id", "host", "path", "rule",
            F.coalesce("said", F.when(F.col("on_list"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
            F.coalesce("on_list", F.lit(False)).alias("listed"),
        )
    )


def repeated_urls(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """A list derived from the pages: URLs whose canonical form more than one page has (crawl traps)."""
    return (
        pages.groupBy(canonical(F.col(url_col)).alias("canon"))
        .agg(F.count("*").alias("n"), F.min(url_col).alias("url"))
        .where("canon is not null and n > 1")
        .select("url")
    )
