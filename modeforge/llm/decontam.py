"""Benchmark decontamination with a generalised suffix automaton of the test items.

Words are runs of ASCII letters and digits, A-Z lower-cased, and of characters beyond ASCII. Items
are cut into blocks of a bounded number of words; each block's automaton is built on the driver and
broadcast. The automata of all blocks are held at once, so the benchmark has to fit there; an item longer than
a block is a block of its own. Documents stream through it: a table of the
items' word pairs finds the stretches in which a match can lie at all, and along these the automaton
tracks the longest match that ends at each word. A match as long as a window (13 words, or all words
of a shorter item) marks those words as hit. Rows are handled one by one, without a shuffle.

Defined cases: a null text has no words; a null item or one without words has no window; equal items
are all named; a null item id counts as no id, its windows still mark words; empty tables give empty
results, or documents without hits; other columns are kept by ``clean_documents`` and not read else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeforge.llm.common import CHUNK_BYTES, chunks

WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
#: Words of the items that one automaton may hold; it has at most twice as many states.
BLOCK_WORDS = 100_000
#: Entries of the table of word pairs.
PAIR_SLOTS = 1 << 22

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: Other ASCII characters become spaces, A-Z become a-z, bytes beyond ASCII stay.
_TO_WORDS = bytes(c if c > 127 or c in _KEEP else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class SuffixAutomaton:
    """The smallest automaton of all runs of words of several items."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, parent: int, child: int, word: int) -> int:
        """A state for the shorter runs of ``child``, those reached from ``parent`` and its links."""
        twin = self._state(self.length[parent] + 1, self.link[child], dict(self.next[child]))
        self.link[child] = twin
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = twin
            parent = self.link[parent]
        return twin

    def add(self, item: Sequence[int]) -> None:
        last = 0
        for word in item:
            last = self._extend(last, word)

    def _extend(self, last: int, word: int) -> int:
        there = self.next[last].get(word)
        if there is not None:  # an earlier item has this run
            return there if self.length[there] == self.length[last] + 1 else self._split(last, there, word)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            child = self.next[at][word]
            self.link[new] = child if self.length[child] == self.length[at] + 1 else self._split(at, child, word)
        return new

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and length of the longest match that ends with ``word``."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        to = self.next[state].get(word)
        return (0, 0) if to is None else (to, length + 1)

    def matches(self, words: Iterable[int]) -> Iterator[tuple[int, int]]:
        state = length = 0
        for word in words:
            state, length = self.step(state, length, word)
            yield state, length


class Windows:
    """The windows of a block of items, found with their automaton."""

    def __init__(self, items: Sequence[tuple[str | None, bytes]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        listed = []
        for name, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if words:
                listed.append((name, words))
        self.shortest = min((min(len(w), window) for _, w in listed), default=0)
        self.automaton = SuffixAutomaton()
        for _, words in listed:
            self.automaton.add(words)
        self.pairs = np.zeros(PAIR_SLOTS, bool)
        owners: dict[tuple[int, int], set[str | None]] = {}
        for name, words in listed:
            ids = np.array(words, np.int64)
            self.pairs[self._slots(ids)] = True
            size = min(len(words), window)
            for i, (state, length) in enumerate(self.automaton.matches(words)):
                if i + 1 >= size:
                    owners.setdefault((self._of_length(state, length, size), size), set()).add(name)
        self.owners = {key: frozenset(names) for key, names in owners.items()}
        self.sizes = sorted({size for _, size in owners})
        self._known: dict[tuple[int, int], tuple[int, frozenset[str | None]]] = {}

    @staticmethod
    def _slots(ids: np.ndarray) -> np.ndarray:
        return (ids[:-1] * 0x9E3779B1 + ids[1:] * 0x85EBCA77) & (PAIR_SLOTS - 1)

    def _of_length(self, state: int, length: int, size: int) -> int:
        """The state of the last ``size`` words of a match."""
        link, lengths = self.automaton.link, self.automaton.length
        while state and lengths[link[state]] >= size:
            state = link[state]
        return state

    def _found(self, state: int, length: int) -> tuple[int, frozenset[str | None]]:
        """Length of the longest window that ends a match, and the items with a window that does."""
        key = (state, min(length, self.window))
        if key not in self._known:
            longest, names = 0, set()
            for size in self.sizes:
                if size <= length and (own := self.owners.get((self._of_length(state, length, size), size))):
                    longest = size
                    names |= own
            self._known[key] = (longest, frozenset(names))
        return self._known[key]

    def hits(self, ids: np.ndarray, start: int, end: int) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Spans of hit words among ``ids[start:end]`` and the items found."""
        spans: list[tuple[int, int]] = []
        names: set[str | None] = set()
        for i, (state, length) in enumerate(self.automaton.matches(ids[start:end].tolist()), start + 1):
            if length >= self.shortest:
                longest, own = self._found(state, length)
                if longest:
                    names |= own
                    if spans and i - longest <= spans[-1][1]:
                        # A longer window may reach back over earlier spans.
                        low = i - longest
                        while spans and spans[-1][1] >= low:
                            low = min(low, spans.pop()[0])
                        spans.append((low, i))
                    else:
                        spans.append((i - longest, i))
        return spans, names

    def scan(self, texts: Sequence[bytes]) -> list[tuple[int, list[tuple[int, int]], set[str | None]]]:
        """Per text: number of words, spans of hit words, items found."""
        lists = [words_of(text) for text in texts]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        total = int(counts.sum())
        found: list[tuple[int, list[tuple[int, int]], set[str | None]]] = [(int(n), [], set()) for n in counts]
        if not total or not self.shortest:
            return found
        ids = np.fromiter((i for words in lists for i in map(self.vocabulary.get, words, repeat(-1))), np.int64, total)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        # A match goes on from one word to the next only over a pair that an item has.
        joined = np.zeros(total, bool)
        if total > 1:
            joined[1:] = (ids[:-1] >= 0) & (ids[1:] >= 0) & self.pairs[self._slots(ids)]
        joined[bounds[:-1][counts > 0]] = False
        starts = np.flatnonzero(~joined)
        ends = np.append(starts[1:], total)
        long = (ends - starts >= self.shortest) & (ids[starts] >= 0)
        for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            spans, names = self.hits(ids, start, end)
            if spans:
                doc = int(np.searchsorted(bounds, start, "right")) - 1
                found[doc][1].extend((a - int(bounds[doc]), b - int(bounds[doc])) for a, b in spans)
                found[doc][2].update(names)
        return found


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items in blocks of bounded size, one after the other on the driver."""
    rows = items.select(F.col(id_col).cast("string"), F.coalesce(F.col(text_col), F.lit("")))
    held, words = [], 0
    for name, text in rows.toLocalIterator(prefetchPartitions=False):
        held.append((name, text.encode()))
        words += len(text) // 2 + 1
        if words >= block_words:
            yield held
            held, words = [], 0
    if held:
        yield held


def _scan_with(docs: DataFrame, windows: Windows, text_col: str) -> DataFrame:
    """``docs`` with ``_scan`` of words, spans and items; rows stay where they are."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)
    columns = docs.columns
    kind = pa.struct([
        ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))), ("items", pa.list_(pa.string())),
    ])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(columns.index(text_col))
            for first, part in chunks((t.as_py().encode() if t.is_valid else b"" for t in texts), CHUNK_BYTES):
                rows = [
                    {"n_words": n, "spans": [{"a": a, "b": b} for a, b in spans], "items": sorted(x for x in names if x is not None)}
                    for n, spans, names in shared.value.scan(part)
                ]
                own = batch.slice(first, len(part))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(rows, kind)], [*columns, "_scan"])

    schema = docs.select("*", F.lit(None).cast("struct<n_words: bigint, spans: array<struct<a: int, b: int>>, items: array<string>>").alias("_scan")).schema
    return docs.mapInArrow(scan, schema)


def scanned(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str, window: int, block_words: int) -> DataFrame:
    """``docs`` with ``_n_words``, merged ``_spans`` of hit words and ``_items``."""
    out = docs.select("*", F.lit(None).cast("bigint").alias("_n_words"), F.expr("cast(array() as array<struct<a: int, b: int>>)").alias("_spans"), F.expr("cast(array() as array<string>)").alias("_items"))
    some = False
    for block in item_blocks(items, item_id, item_text, block_words):
        some = True
        out = _scan_with(out, Windows(block, window), text_col)
        out = out.select(
            *docs.columns,
            F.col("_scan.n_words").alias("_n_words"),
            F.concat("_spans", "_scan.spans").alias("_spans"),
            F.array_union("_items", "_scan.items").alias("_items"),
        )
    if not some:
        out = _scan_with(out, Windows([], window), text_col).select(*docs.columns, F.col("_scan.n_words").alias("_n_words"), "_spans", "_items")
    return out


def _n_hit(spans: str = "_spans"):
    """Words in the union of spans."""
    return F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["end"]))).cast("bigint").alias("n"), F.greatest(x["b"], s["end"]).alias("end")
        ),
        lambda s: s["n"],
    )


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, one_in: int = ONE_IN, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items, contaminated`` for every row."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = scanned(narrow, items, "text", item_id, item_text, window, block_words)
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), _n_hit().alias("n_hit"), F.array_sort("_items").alias("items")
    ).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items",
        ((F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def clean_documents(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, one_in: int = ONE_IN, block_words: int = BLOCK_WORDS, cut_spans: bool = False,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns.

    With ``cut_spans`` the hit words of rows below the coverage limit are cut from the text.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("row"), F.col(text_col).alias("text"))
    found = scanned(packed, items, "text", item_id, item_text, window, block_words).withColumn("_n_hit", _n_hit())
    kept = found.where(~((F.col("_n_hit") > 0) & (one_in * F.col("_n_hit") >= F.col("_n_words"))))
    text = F.col("text")
    if cut_spans:
        text = F.when(F.col("_n_hit") > 0, _cut_udf()(text, F.col("_spans"))).otherwise(text)
    return kept.select(*(text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns))


def cut_words(text: str, spans: Sequence[tuple[int, int]]) -> str:
    """The text without the words of the spans, from the first letter of each span to its last."""
    raw = text.encode()
    places, start = [], -1
    for i, c in enumerate(raw.translate(_TO_WORDS) + b" "):
        if c == 32 and start >= 0:
            places.append((start, i))
            start = -1
        elif c != 32 and start < 0:
            start = i
    out, done = [], 0
    for a, b in sorted(spans):
        if places[b - 1][1] > done:
            out.append(raw[done : max(done, places[a][0])])
            done = places[b - 1][1]
    return b"".join([*out, raw[done:]]).decode()


def _cut_udf():
    @F.udf("string", useArrow=True)
    def cut(text, spans):
        return cut_words(text, [(s["a"], s["b"]) for s in spans]) if text and len(spans) else text

    return cut


def items_digest(items: str = "items"):
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def brute_force(text: str | None, items: Sequence[tuple[int, str]], window: int = WINDOW) -> tuple[int, int, list[str], str]:
    """The contract's result for one text, word by word; for tests."""
    words = words_of((text or "").encode())
    hit, names = set(), set()
    for name, item in items:
        own = words_of(item.encode())
        size = min(window, len(own))
        for j in range(len(own) - size + 1) if size else []:
            for i in range(len(words) - size + 1):
                if words[i : i + size] == own[j : j + size]:
                    hit.update(range(i, i + size))
                    names.add(str(name))
    listed = sorted(names)
    return len(words), len(hit), listed, hashlib.sha256(",".join(listed).encode()).hexdigest()
