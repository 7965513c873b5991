"""Spelling variants: a vocabulary composed with a one-edit transducer and with itself again.

Words are counted in the tasks that read the texts, in tables of bounded size. Two words that differ by one
edit agree before the first place where they differ, and again behind the edit. So the places
of a word are cut into ``PARTS`` parts, and a word is written once for each part: the part itself is
the *middle*, the part's number and all around it is the *key*. A pair meets under the key whose part holds its first
difference, and nowhere else. A key is an initial state: of the automaton that accepts key and middle, and of
the composition, whose transducer copies the key and edits in the middle. Keys are dealt out by Spark; a key with
more than ``HEAVY`` words is cut on into parts of one place, where a key has no more words than there are letters.

A task builds the minimised acyclic acceptors of the middles under all its keys in one register, so keys share states. A state
knows how many words it accepts, which numbers them without naming them. The composition walks
``acceptor x edit x acceptor`` from each initial state: along equal letters until a first difference
(replace one letter by another, or drop a letter of the longer word), then along equal letters to the end.
Pairs of numbers are worked out once per pair of states, whatever the keys and paths that lead there.

Sums over the pairs of a word are taken in the task and once more in Spark; pairs themselves are not shuffled.

Defined cases: a null or empty text has no words; a null id counts as empty text before the ``:``; repeated rows
count each time; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeforge.llm.common import broadcast_if_bounded, chunks, staged

MIN_LENGTH, MIN_COUNT = 5, 3
#: One in so many (run, document) loses a letter.
ONE_IN = 97
#: A form has at least so many times the word's occurrences.
TIMES = 2
PARTS = 2
#: Words under one key that a task takes at once; a key with more is cut on.
HEAVY = 20_000
#: Words whose acceptors share one register.
REGISTER_WORDS = 60_000
#: Words that a task counts before it hands them on.
TABLE_WORDS = 300_000

RUN = re.compile("[a-zÀ-ÿ]+")


def words_in(doc_id: str, text: bytes) -> Counter[str]:
    """Counts of the words of one text, shortened where the rule says so."""
    found: Counter[str] = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(RUN.findall(text.lower().decode())).items():
        h = zlib.crc32(run.encode(), start)
        if h % ONE_IN == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= MIN_LENGTH:
            found[run] += n
    return found


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of all words that are long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in chunks(t.as_py() or b"" for t in batch.column(1)):
                for i, text in enumerate(texts, first):
                    held.update(words_in(ids[i], text))
                if len(held) >= TABLE_WORDS:
                    yield rows()
                    held.clear()
        yield rows()

    source = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("binary"))
    return source.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _keyed(words: DataFrame, size: Column, part: Column, first: Column, end: Column) -> DataFrame:
    """``key, middle, long, word, n``: the places ``first`` to ``end`` of a word of ``size`` places are the middle.

    ``size`` is the length of the longer word of a pair, so a shorter word has one place less in its middle. The
    letter behind is taken along, or ``.`` at the end of the word: a dropped letter counts at its last possible place.
    """
    length = F.char_length("word")
    key = F.concat_ws(
        " ", size.cast("string"), part.cast("string"), F.expr("substring(word, 1, _first)"), F.expr("right(word, _tail)")
    )
    placed = words.withColumn("_first", first.cast("int")).withColumn("_tail", (size - end).cast("int"))
    return placed.select(
        key.alias("key"),
        F.expr("substring(concat(word, '.'), _first + 1, char_length(word) - _first - _tail + 1)").alias("middle"),
        (length == size).alias("long"),
        "word",
        "n",
        *(c for c in words.columns if c not in ("word", "n", "key")),
    )


def keyed(words: DataFrame, parts: int = PARTS, heavy: int = HEAVY) -> DataFrame:
    """Every word under all keys where a pair of it may meet: ``key, middle, long, word, n``."""
    length = F.char_length("word")
    sizes = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("size"))
    coarse = sizes.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    size, part = F.col("size"), F.col("part")
    bounds = [F.floor(size * p / parts) for p in (part, part + 1)]
    split = staged(_keyed(coarse, size, part, *bounds), "keyed-words")
    crowded = split.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > heavy).select("key")
    crowded = broadcast_if_bounded(staged(crowded, "crowded-keys"))
    places = F.sequence(F.floor(size * part / parts), F.floor(size * (part + 1) / parts) - 1)
    single = split.join(crowded, "key", "left_semi").select("word", "n", "size", F.explode(places).alias("part"))
    fine = _keyed(single, size, part, part, part + 1).withColumn("key", F.concat(F.lit("."), "key"))
    columns = ["key", "middle", "long", "word", "n"]
    return split.join(crowded, "key", "left_anti").select(*columns).unionByName(fine.select(*columns))


class Acceptors:
    """Minimised acyclic acceptors in one register; states are numbered, equal ones once.

    ``arcs[s]`` lists ``(letter, state, number of words before)``, in the order of letters.
    """

    def __init__(self) -> None:
        self.final: list[bool] = []
        self.words: list[int] = []
        self.arcs: list[tuple[tuple[str, int, int], ...]] = []
        self.by_letter: list[dict[str, tuple[int, int]]] = []
        self._register: dict[tuple[bool, tuple[tuple[str, int], ...]], int] = {}
        self._same: dict[tuple[int, int], np.ndarray] = {}
        self._replaced: dict[int, np.ndarray] = {}
        self._dropped: dict[tuple[int, int], np.ndarray] = {}

    def _state(self, final: bool, arcs: tuple[tuple[str, int], ...]) -> int:
        known = self._register.get((final, arcs))
        if known is None:
            known = self._register[final, arcs] = len(self.final)
            before, numbered = int(final), []
            for letter, to in arcs:
                numbered.append((letter, to, before))
                before += self.words[to]
            self.final.append(final)
            self.words.append(before)
            self.arcs.append(tuple(numbered))
            self.by_letter.append({letter: (to, at) for letter, to, at in numbered})
        return known

    def add(self, words: list[str]) -> int:
        """The initial state of the minimised acceptor of sorted distinct words."""
        # Open states of the last word, from the front: final, arcs that are done, letter that leads on.
        path: list[tuple[bool, list[tuple[str, int]]]] = [(False, [])]
        letters: list[str] = []
        for word in words:
            shared = 0
            for a, b in zip(letters, word, strict=False):
                if a != b:
                    break
                shared += 1
            self._close(path, letters, shared)
            for letter in word[shared:]:
                letters.append(letter)
                path.append((False, []))
            path[-1] = (True, path[-1][1])
        self._close(path, letters, 0)
        final, arcs = path[0]
        return self._state(final, tuple(arcs))

    def _close(self, path: list, letters: list[str], depth: int) -> None:
        while len(letters) > depth:
            final, arcs = path.pop()
            path[-1][1].append((letters.pop(), self._state(final, tuple(arcs))))

    def same(self, p: int, q: int) -> np.ndarray:
        """Numbers of the words that both states accept, as rows (number in p, number in q)."""
        if p == q:
            every = np.arange(self.words[p])
            return np.column_stack([every, every])
        known = self._same.get((p, q))
        if known is None:
            parts = [np.zeros((1, 2), np.int64)] if self.final[p] and self.final[q] else []
            there = self.by_letter[q]
            for letter, to, before in self.arcs[p]:
                other = there.get(letter)
                if other is not None:
                    found = self.same(to, other[0])
                    if len(found):
                        parts.append(found + (before, other[1]))
            known = self._same[p, q] = _joined(parts)
        return known

    def replaced(self, p: int) -> np.ndarray:
        """Pairs of words of ``p`` that differ in one letter, the smaller first."""
        known = self._replaced.get(p)
        if known is None:
            parts = []
            arcs = self.arcs[p]
            for i, (_, to, before) in enumerate(arcs):
                parts.append(self.replaced(to) + before)
                for _, other, at in arcs[i + 1 :]:
                    parts.append(self.same(to, other) + (before, at))
            known = self._replaced[p] = _joined(parts)
        return known

    def dropped(self, p: int, q: int) -> np.ndarray:
        """Pairs of a word of ``p`` and one of ``q`` that is the first without one letter, which is not its last."""
        known = self._dropped.get((p, q))
        if known is None:
            parts = []
            here, there = self.arcs[p], self.by_letter[q]
            for letter, to, before in here:
                # Equal letters: no difference yet.
                other = there.get(letter)
                if other is not None:
                    parts.append(self.dropped(to, other[0]) + (before, other[1]))
                # The letter is dropped, and the next one is another.
                onward = self.by_letter[to]
                for after, (goal, at) in there.items():
                    if after != letter and after in onward:
                        state, further = onward[after]
                        parts.append(self.same(state, goal) + (before + further, at))
            known = self._dropped[p, q] = _joined(parts)
        return known


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    parts = [x for x in parts if len(x)]
    if len(parts) == 1:
        return parts[0]
    return np.concatenate(parts) if parts else np.zeros((0, 2), np.int64)


def near_pairs(longer: list[str], shorter: list[str], acceptors: Acceptors) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in sorted lists: among ``longer`` by one replaced letter, and with ``shorter`` by a dropped one.

    Words of ``longer`` have one length, those of ``shorter`` one less; the last letter of all stands for what follows.
    """
    p = acceptors.add(longer)
    q = acceptors.add(shorter) if shorter else None
    return acceptors.replaced(p), acceptors.dropped(p, q) if q is not None else np.zeros((0, 2), np.int64)


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, middle, long, word, n``, sorted by all three first: what each word finds under its keys."""
    acceptors, used = Acceptors(), 0
    words_out: list[str] = []
    counts_out: list[int] = []
    forms_out: list[str] = []
    form_n_out: list[int] = []

    def settle(longer: list[tuple[str, str, int]], shorter: list[tuple[str, str, int]]) -> None:
        nonlocal acceptors, used
        if not longer or len(longer) + len(shorter) < 2:
            return
        if used > REGISTER_WORDS:
            acceptors, used = Acceptors(), 0
        used += len(longer) + len(shorter)
        # States of a path are calls inside calls.
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 3 * max(len(m) for m, _, _ in longer) + 1000))
        replaced, dropped = near_pairs([m for m, _, _ in longer], [m for m, _, _ in shorter], acceptors)
        if not len(replaced) and not len(dropped):
            return
        rows = longer + shorter
        ends = np.concatenate([replaced, dropped + (0, len(longer))])
        a, b = np.concatenate([ends[:, 0], ends[:, 1]]), np.concatenate([ends[:, 1], ends[:, 0]])
        n = np.array([x[2] for x in rows], np.int64)
        by_word = np.empty(len(rows), np.int64)
        by_word[sorted(range(len(rows)), key=lambda k: rows[k][1])] = np.arange(len(rows))
        order = np.lexsort((by_word[b], -n[b], a))
        firsts = np.flatnonzero(np.diff(a[order], prepend=-1))
        many = np.diff(firsts, append=len(order))
        for i, k in zip(order[firsts].tolist(), many.tolist(), strict=True):
            words_out.append(rows[a[i]][1])
            counts_out.append(k)
            forms_out.append(rows[b[i]][1])
            form_n_out.append(rows[b[i]][2])

    def rows_out() -> pa.RecordBatch:
        columns = [pa.array(words_out, pa.string()), pa.array(counts_out, pa.int64()), pa.array(forms_out, pa.string()), pa.array(form_n_out, pa.int64())]
        for x in (words_out, counts_out, forms_out, form_n_out):
            x.clear()
        return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "near", "near_n"])

    key, longer, shorter = None, [], []
    for batch in batches:
        for own, middle, long, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != key:
                settle(longer, shorter)
                key, longer, shorter = own, [], []
            (longer if long else shorter).append((middle, word, n))
        if len(words_out) > 50_000:
            yield rows_out()
    settle(longer, shorter)
    yield rows_out()


def neighbours(words: DataFrame, parts: int = PARTS, heavy: int = HEAVY) -> DataFrame:
    """``word, n_near, form, form_n`` of the words that have a near word; ``form`` whatever its count."""
    met = keyed(words, parts, heavy).repartition("key").sortWithinPartitions("key", "middle")
    found = met.mapInArrow(_compose, "word string, n_near bigint, near string, near_n bigint")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: the last form, found by doubling the steps. A form's count is greater, so there is no way round."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        after = staged(step, "roots")
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the vocabulary."""
    words = staged(vocabulary(docs, id_col, text_col), "vocabulary")
    near = words.join(neighbours(words), "word", "left")
    fits = F.col("form_n") >= TIMES * F.col("n")
    table = staged(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(fits, F.col("form")).alias("form"),
            F.when(fits, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(table.where("form IS NOT NULL").select("word", "form"))
    return table.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
