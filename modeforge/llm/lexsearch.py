"""Ranked lexical search: all items are evaluated together and share their common subexpressions.

The items of a pass are cut into blocks of ``BLOCK_ITEMS``. In a block every term has a mask, the set of
the block's items that hold it. Terms of one mask are a *shared term set*: whatever item needs one of
them needs all. The sets of each item, those of most items first, are entered into a tree, so items that begin with
the same sets share the nodes of that beginning. Sets and nodes together are the query-sharing DAG:

* a set's accumulator is the sum over its terms, worked out once for a document;
* a node's accumulator is that of its parent plus that of one set; a set may serve many nodes;
* an item's score is the accumulator of the node where its path ends.

Documents pass in three steps. The first finds their terms, keeps those that some item asks for and writes them;
N, L and the document frequencies are summed from there; then the written postings are run through the DAG
in numpy, many documents at a time, and every task hands on its best rows of each item.
Nothing of a document but its postings is shuffled or written, and only best rows meet.

Items are taken in passes of at most ``PASS_TERMS`` term occurrences, whatever their number, so the dictionary that tasks hold has
a bound; a single item with more terms is a pass of its own.

Defined cases: a null or empty text has no term and is never found; an item without a term has no rows; items with the same id
(null too) are one item with the terms of all; rows with the same id are documents of their own, and
each may be found; of equal scores null ids come last, rows that agree in id and score are alike; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modeforge.llm.common import ascii_lower, staged

TOP = 50
#: Items whose masks are one integer.
BLOCK_ITEMS = 64
#: Term occurrences of the items of one pass over the documents: a dictionary of some 25 MB.
PASS_TERMS = 250_000
#: Cells (rows of accumulators x documents) that a task holds at a time.
CELLS = 2_000_000

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TERM_JAVA = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Shared:
    """The query-sharing DAG of one block of items.

    ``set_of[t]`` is the set of term ``t`` (-1: no item of the block asks for it). Node 0 is empty; node ``k`` is
    ``parent[k - 1]`` plus ``added[k - 1]``, and parents come first. ``ends[i]`` is the node of the block's item ``i``.
    """

    n_sets: int
    set_of: np.ndarray
    parent: list[int]
    added: list[int]
    ends: list[int]


def share(items: Sequence[Iterable[int]], n_terms: int) -> Shared:
    """Mine the shared term sets of a block of items and lay them out as a DAG."""
    if len(items) > BLOCK_ITEMS:
        raise ValueError(f"a block has at most {BLOCK_ITEMS} items")
    masks: dict[int, int] = {}
    for i, terms in enumerate(items):
        for t in terms:
            masks[t] = masks.get(t, 0) | 1 << i
    order = sorted(set(masks.values()), key=lambda m: (-m.bit_count(), m))
    number = {m: k for k, m in enumerate(order)}
    set_of = np.full(n_terms, -1, np.int32)
    for t, m in masks.items():
        set_of[t] = number[m]
    parent: list[int] = []
    added: list[int] = []
    ends = []
    known: dict[tuple[int, int], int] = {}
    for i in range(len(items)):
        node = 0
        for k, m in enumerate(order):
            if m >> i & 1:
                after = known.get((node, k))
                if after is None:
                    parent.append(node)
                    added.append(k)
                    after = known[node, k] = len(parent)
                node = after
        ends.append(node)
    return Shared(len(order), set_of, parent, added, ends)


def weigh(tf: np.ndarray, m: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What a term adds to a score; 64-bit integers, division rounds down."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def run(dag: Shared, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
    """Scores, one row for each item of the block and one column for each document."""
    own = dag.set_of[term]
    used = own >= 0
    sets = np.zeros((dag.n_sets, n_docs), np.int64)
    np.add.at(sets.reshape(-1), own[used].astype(np.int64) * n_docs + doc[used], value[used])
    nodes = np.zeros((len(dag.parent) + 1, n_docs), np.int64)
    for k, (p, s) in enumerate(zip(dag.parent, dag.added, strict=True), 1):
        np.add(nodes[p], sets[s], out=nodes[k])
    return nodes[dag.ends]


class Best:
    """The best rows of each item of a block among those seen."""

    def __init__(self, n_items: int, top: int):
        self.top, self.floor = top, np.ones(n_items, np.int64)
        self.held: list[list[tuple[int, bool, int]]] = [[] for _ in range(n_items)]

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        for i in np.flatnonzero(scores.max(axis=1, initial=0) >= self.floor).tolist():
            row = scores[i]
            found = np.flatnonzero(row >= self.floor[i])
            if len(found) > 4 * self.top:  # ties of the last place are all kept until ids decide
                least = np.partition(row[found], -self.top)[-self.top]
                found = found[row[found] >= least]
            fresh = [(-s, ids[d] is None, ids[d] or 0) for s, d in zip(row[found].tolist(), found.tolist(), strict=True)]
            self.held[i] = sorted(self.held[i] + fresh)[: self.top]
            if len(self.held[i]) == self.top:
                self.floor[i] = -self.held[i][-1][0]


def _postings(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document with a term; only terms that are asked for are listed."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, sizes, bounds, terms_out, tfs_out = [], [], [0], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                raw = text.as_buffer()
                words = TERM.findall(raw.to_pybytes().lower()) if raw is not None else []
                if not words:
                    continue
                for word, tf in Counter(words).items():
                    t = known.get(word)
                    if t is not None:
                        terms_out.append(t)
                        tfs_out.append(tf)
                ids.append(doc_id.as_py())
                sizes.append(len(words))
                bounds.append(len(terms_out))
            bounds = pa.array(bounds, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(bounds, pa.array(terms_out, pa.int32())),
                    pa.ListArray.from_arrays(bounds, pa.array(tfs_out, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        find, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"
    )


def _search(postings: DataFrame, dags: list[Shared], weights: np.ndarray, n: int, length: int, top: int) -> DataFrame:
    """``item`` (its number in the pass), ``doc_id, score, task``: the best rows of each task."""
    shared = postings.sparkSession.sparkContext.broadcast((dags, weights))
    columns = ["doc_id", "n", "terms", "tfs"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans, w = shared.value
        best = [Best(len(dag.ends), top) for dag in plans]
        step = max(1, CELLS // max(len(dag.parent) + dag.n_sets + 1 for dag in plans))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                ids = part.column(0).to_pylist()
                m = 50 + (50 * part.column(1).to_numpy() * n) // length
                lists = part.column(2)
                doc = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
                term = lists.flatten().to_numpy()
                value = weigh(part.column(3).flatten().to_numpy(), m[doc], w[term])
                for dag, held in zip(plans, best, strict=True):
                    held.add(run(dag, doc, term, value, len(ids)), ids)
        rows = [
            (b * BLOCK_ITEMS + i, None if none else doc_id, -s)
            for b, held in enumerate(best)
            for i, found in enumerate(held.held)
            for s, none, doc_id in found
        ]
        items, ids, scores = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    return postings.select(*columns).mapInArrow(search, "item int, doc_id bigint, score bigint").withColumn("task", F.spark_partition_id())


def _first(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def passes(items: DataFrame, item_id: str, text: str, pass_terms: int) -> Iterator[list[tuple[int | None, list[str]]]]:
    """Items with their distinct terms, some ``pass_terms`` occurrences at a time."""
    found = (
        items.select(F.col(item_id).alias("item_id"), F.explode(F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(TERM_JAVA), F.lit(0))).alias("term"))
        .groupBy("item_id")
        .agg(F.array_sort(F.collect_set("term")).alias("terms"))
    )
    held, size = [], 0
    for row in staged(found, "item-terms").toLocalIterator():
        if held and size + len(row["terms"]) > pass_terms:
            yield held
            held, size = [], 0
        held.append((row["item_id"], row["terms"]))
        size += len(row["terms"])
    if held:
        yield held


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", top: int = TOP, pass_terms: int = PASS_TERMS,
) -> DataFrame:
    """The ``top`` documents of each item: ``item_id, rank, doc_id, score``."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    kind = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for batch in passes(items, item_id, item_text, pass_terms):
        words = sorted({t for _, terms in batch for t in terms})
        number = {w.encode(): k for k, w in enumerate(words)}
        postings = staged(_postings(narrow, number), "postings")
        n, length = postings.agg(F.count("*"), F.sum("n")).first()
        if not n:
            continue
        df = F.col("df")
        weights = np.zeros(len(words), np.int64)
        counted = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        for row in counted.select("term", F.floor(1000 * F.log((2 * n + 2) / (2 * df + 1))).alias("w")).collect():
            weights[row["term"]] = row["w"]
        asked = [[number[t.encode()] for t in terms] for _, terms in batch]
        dags = [share(asked[i : i + BLOCK_ITEMS], len(words)) for i in range(0, len(batch), BLOCK_ITEMS)]
        found = staged(_search(postings, dags, weights, n, length, top), "best-rows")
        tasks = (found.agg(F.max("task")).first()[0] or 0) + 1
        parts = int(tasks**0.5)  # the best rows of all tasks of an item meet in two steps
        some = _first(found.withColumn("part", F.pmod("task", F.lit(parts))), ["item", "part"], top)
        names = spark.createDataFrame([(k, name) for k, (name, _) in enumerate(batch)], f"item int, item_id {kind}")
        ranked = _first(some.drop("rank"), ["item"], top).join(F.broadcast(names), "item")
        out = out.unionByName(ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out
