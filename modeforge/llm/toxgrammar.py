"""Toxicity by a weighted finite-state pattern grammar.

Words become classes by a lexicon: insults and threats in all their forms, targets, negation with its
contractions, reported speech and ends of clauses. Small weighted transducers rewrite the stream of classes one after
the other: the first gives insults and threats their weight, negation takes some from what
follows it within a few words, a verb of speech from what stands in its clause, before it or behind, and a target nearby
adds some and makes an insult or a threat an aimed one. They are composed into one table before the run,
in which weights are added up along the moves. A clause counts by its heaviest pattern, and a document is
scored by its counts of matched clauses.

Learnt are the insults and the weights of the patterns, from text and label alone. Insults are word
beginnings that documents labelled toxic have and others don't; support counts groups of like
documents, by a min-hash of their shingles, so that copies of one document teach nothing. Fitting reads
at most ``SAMPLE_ROWS`` labelled rows, taken by a hash of the id; every document is scored on its
whole text by a narrow map without a shuffle.

Defined cases: a null or empty text has no clause and gets the score of no match; a null label is
not learnt from; of several labels of one id the largest counts; without labelled rows of both kinds
the prior weights are used; an empty table gives an empty result; other columns are kept by
``harmless_documents`` and not read else.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeforge.llm.common import chunks, id_crc, unit_draw
from modeforge.llm.shingles import shingle_sets

#: Labelled rows that the fit reads at the most.
SAMPLE_ROWS = 40_000
#: Lengths of word beginnings that may become insults.
SHORTEST, LONGEST = 4, 8
#: Least part of the groups of toxic documents, and least number, that a word beginning must be in.
LEAST_SHARE, LEAST_SUPPORT = 0.01, 4
#: Of the documents with a word beginning, so many must be toxic.
PRECISION = 0.99
THRESHOLD = 0.7
#: Words over which negation and targets reach.
SCOPE = 3

# Closed word classes of the four languages of the corpus.
TARGETS = frozenset("you your yours youre he she they them him her du dich dir ihr euch sie er tu te toi vous il elle ils tú te ti usted ustedes él ella ellos".split())
NEGATIONS = frozenset("not no never neither nor nobody isnt arent nicht kein keine nie niemals pas jamais aucun nunca jamás tampoco ningún".split())
REPORTS = frozenset("said says quoted reported wrote called sagte sagt schrieb zitierte dit disait écrit cité dijo dice escribió llamó".split())
#: Beginnings of verbs and the endings that make their forms.
THREAT_FORMS = {
    "kill hurt destroy murder shoot stab": " s ed ing er ers", "shot killing stabbed stabbing": "",
    "töt getöt vernicht": "e en et est ete eten", "umbring umgebracht": " e en t st end",
    "tuer tuerai tuera tuerons tueront tués frapper frappez frappé détruire détruirai détruit": "",
    "matar mataré matará mataremos matado destruir destruiré destruido golpear golpearé golpeado": "",
}
THREATS = frozenset(verb + end for verbs, ends in THREAT_FORMS.items() for verb in verbs.split() for end in ends.split(" "))

INSULT, THREAT, TARGET, NEGATION, REPORT, STOP, OTHER = "insult", "threat", "target", "negation", "report", "stop", "other"
#: A verb of speech takes back what its clause has said before.
RETOLD = "retold"
SYMBOLS = (INSULT, THREAT, TARGET, NEGATION, REPORT, STOP, OTHER)
#: Patterns from weak to strong, with prior weights of the first matched clause.
PATTERNS = ("reported", "negated", "insult", "threat", "aimed insult", "aimed threat")
#: Weights of the moves: of a match, of weakening it and of aiming it.
MATCHED, WEAKENED, AIMED = 4.0, -3.5, 1.0
PRIOR = {
    "reported": MATCHED + WEAKENED, "negated": MATCHED + WEAKENED, "insult": MATCHED, "threat": MATCHED,
    "aimed insult": MATCHED + AIMED, "aimed threat": MATCHED + AIMED,
}

_WORDS = re.compile(r"[^\W\d_]+")
#: A contraction is one word, a negation; other apostrophes part words, as in French.
_PARTS = re.compile(r"[^\W\d_]+n['’]t(?![^\W\d_])|[^\W\d_]+|[.!?;\n]")


@dataclass
class Transducer:
    """Moves from state 0: ``(state, symbol) -> (state, symbol, weight)``."""

    moves: dict[tuple[int, str], tuple[int, str, float]]

    def then(self, other: Transducer) -> Transducer:
        """One transducer that does the work of both, with weights added; only states that can be reached."""
        symbols = {symbol for _, symbol in self.moves}
        numbers, moves, todo = {(0, 0): 0}, {}, deque([(0, 0)])
        while todo:
            pair = todo.popleft()
            for symbol in sorted(symbols):
                a, between, first = self.moves[pair[0], symbol]
                b, out, second = other.moves[pair[1], between]
                if (a, b) not in numbers:
                    numbers[a, b] = len(numbers)
                    todo.append((a, b))
                moves[numbers[pair], symbol] = (numbers[a, b], out, first + second)
        return Transducer(moves)

    def run(self, symbols: Iterable[str]) -> Iterator[tuple[str, float]]:
        state = 0
        for symbol in symbols:
            state, out, weight = self.moves[state, symbol]
            yield out, weight


def _matching(symbols: Sequence[str]) -> Transducer:
    """Insults and threats get their weight."""
    return Transducer({(0, s): (0, s, MATCHED if s in (INSULT, THREAT) else 0.0) for s in symbols})


def _weakening(trigger: str, symbols: Sequence[str], to: str, reach: int | None, leaves: str = OTHER) -> Transducer:
    """After ``trigger``, insults and threats become ``to``, for ``reach`` words or to the clause's end.

    The trigger itself becomes ``leaves``.
    """
    moves = {}
    last = reach or 1
    for state, symbol in itertools.product(range(last + 1), symbols):
        after = max(0, state - 1) if reach else state
        if symbol == trigger:
            moves[state, symbol] = (last, leaves, 0.0)
        elif symbol == STOP:
            moves[state, symbol] = (0, STOP, 0.0)
        elif state and symbol in (INSULT, THREAT):
            moves[state, symbol] = (after, to, WEAKENED)
        else:
            moves[state, symbol] = (after, symbol, 0.0)
    return Transducer(moves)


def _aiming(symbols: Sequence[str]) -> Transducer:
    """A target up to ``SCOPE`` words before or after makes an insult or a threat an aimed one.

    State 0 is nothing near; 1 to SCOPE a target so near before; beyond that an insult, then a threat.
    """
    moves = {}
    for state, symbol in itertools.product(range(3 * SCOPE + 1), symbols):
        band, left = divmod(state - 1, SCOPE) if state else (-1, 0)
        after = state - 1 if left else 0
        if symbol == STOP:
            moves[state, symbol] = (0, STOP, 0.0)
        elif symbol == TARGET:
            # The match before it is paid for already, so it counts in full here, as an aimed one.
            out = {1: "aimed insult", 2: "aimed threat"}.get(band, OTHER)
            moves[state, symbol] = (SCOPE, out, 0.0 if out == OTHER else MATCHED + AIMED)
        elif symbol == RETOLD:
            # What was said before waits for no target any more.
            moves[state, symbol] = (after if band == 0 else 0, RETOLD, 0.0)
        elif symbol in (INSULT, THREAT):
            hit = 2 * SCOPE if symbol == INSULT else 3 * SCOPE
            moves[state, symbol] = (after, f"aimed {symbol}", AIMED) if band == 0 else (hit, symbol, 0.0)
        else:
            moves[state, symbol] = (after, symbol, 0.0)
    return Transducer(moves)


def grammar() -> Transducer:
    negation = _weakening(NEGATION, SYMBOLS, "negated", SCOPE)
    report = _weakening(REPORT, [s for s in (*SYMBOLS, "negated") if s != NEGATION], "reported", None, RETOLD)
    aim = _aiming([INSULT, THREAT, TARGET, STOP, OTHER, "negated", "reported", RETOLD])
    return _matching(SYMBOLS).then(negation).then(report).then(aim)


@dataclass
class Model:
    """Insults as word beginnings, and the weights of the patterns."""

    insults: frozenset[str]
    weights: np.ndarray = field(default_factory=lambda: np.array([-4.0, *(PRIOR[p] for p in PATTERNS)]))

    def __post_init__(self) -> None:
        self.table = grammar()
        self.heads = frozenset(x[:SHORTEST] for x in self.insults) | frozenset(x[:SHORTEST] for x in THREATS)

    def word_class(self, word: str) -> str:
        if word[:SHORTEST] in self.heads:
            if word in THREATS:
                return THREAT
            if any(word[:n] in self.insults for n in range(SHORTEST, LONGEST + 1)):
                return INSULT
        if word in TARGETS:
            return TARGET
        if word in NEGATIONS or word[-2:] in ("'t", "’t"):
            return NEGATION
        return REPORT if word in REPORTS else OTHER

    def clauses(self, text: str) -> list[int]:
        """Number of clauses whose strongest pattern is each of ``PATTERNS``."""
        counts = [0] * len(PATTERNS)
        low = text.lower()
        if not any(w[:SHORTEST] in self.heads for w in set(_WORDS.findall(low))):
            return counts
        symbols = (STOP if len(p) == 1 and not p.isalpha() else self.word_class(p) for p in _PARTS.findall(low))
        best = None
        for out, weight in itertools.chain(self.table.run(symbols), [(STOP, 0.0)]):
            if out == STOP:
                if best is not None:
                    counts[best[1]] += 1
                best = None
            elif out == RETOLD:
                best = best and (PRIOR["reported"], PATTERNS.index("reported"))
            elif weight:
                found = (weight, PATTERNS.index(out))
                best = found if best is None else max(best, found)
        return counts

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(counts) @ self.weights, -30, 30)))


def features(counts: np.ndarray) -> np.ndarray:
    """A constant and, by pattern, the dampened number of clauses."""
    counts = np.asarray(counts, float).reshape(-1, len(PATTERNS))
    return np.column_stack([np.ones(len(counts)), np.log2(1 + counts)])


def fit_weights(counts: np.ndarray, toxic: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps, drawn to the prior weights where data say little."""
    prior = Model(frozenset()).weights
    x, y, w = features(counts), np.asarray(toxic, float), prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * (w - prior)
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _beginnings(text: str) -> set[str]:
    words = set(_WORDS.findall(text.lower()))
    return {w[:n] for w in words for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for first, part in chunks(t.as_py().encode() if t.is_valid else b"" for t in batch.column("text")):
            yield batch.slice(first, len(part)), part


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, learn: Callable | None) -> DataFrame:
    """``text, toxic`` of at most about ``rows`` rows to learn from, found without moving texts."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if learn is not None:
        known = known.where(learn("doc_id"))
    share = rows / max(1, known.count())
    if share < 1:
        known = known.where(unit_draw(F.col("doc_id").cast("string"), "toxicity sample") < share)
    # Bounded by ``rows``, so it may be broadcast.
    return docs.join(F.broadcast(known), "doc_id").select("text", "toxic")


def choose_insults(support: dict[str, int], toxic: dict[str, int], other: dict[str, int], groups: int) -> frozenset[str]:
    """The shortest word beginnings with support that no other document has.

    One that few others have is taken only if no longer, cleaner one is in nearly all its documents.
    """
    least = max(LEAST_SUPPORT, LEAST_SHARE * groups)
    known = [x for x in sorted(support) if support[x] >= least]
    clean = {x for x in known if not other.get(x)}
    nearly = {x for x in known if x not in clean and toxic[x] >= PRECISION * (toxic[x] + other[x])}
    good = clean | {x for x in nearly if not any(y.startswith(x) and toxic[y] >= 0.9 * toxic[x] for y in clean)}
    return frozenset(x for x in good if not any(x[:n] in good for n in range(SHORTEST, len(x))))


def fit(docs: DataFrame, labels: DataFrame, learn: Callable | None = None, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``, rows with ``learn(id)`` only."""
    sample = labelled_sample(docs, labels, rows, learn)

    def toxic_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in _texts(batches):
            marks, words = [], []
            for text, own in zip(part, shingle_sets(part, 5), strict=True):
                found = _beginnings(text.decode())
                words += found
                marks += [int(own[0] >> np.uint64(1)) if len(own) else 0] * len(found)
            yield pa.RecordBatch.from_pydict({"word": words, "mark": marks}, pa.schema([("word", pa.string()), ("mark", pa.int64())]))

    bad = sample.where("toxic = 1").select("text")
    marked = bad.mapInArrow(toxic_words, "word string, mark long")
    groups = marked.agg(F.count_distinct("mark")).first()[0]
    least = max(LEAST_SUPPORT, LEAST_SHARE * groups)
    # Words of many groups only: a bounded list, as a document has a bounded number of them.
    supported = marked.groupBy("word").agg(F.count_distinct("mark").alias("n"), F.count("*").alias("docs")).where(F.col("n") >= least).collect()
    support = {r["word"]: r["n"] for r in supported}
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(support))

    def other_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for _, part in _texts(batches):
            for text in part:
                counts.update(_beginnings(text.decode()) & shared.value)
        yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())}, pa.schema([("word", pa.string()), ("n", pa.int64())]))

    other = sample.where("toxic = 0").select("text").mapInArrow(other_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    model = Model(choose_insults(support, {r["word"]: r["docs"] for r in supported}, {r["word"]: r["n"] for r in other}, groups))
    rows_seen = _counted(sample, model, "toxic int").groupBy("counts", "toxic").agg(F.count("*").alias("n")).collect()
    counts = np.array([r["counts"] for r in rows_seen], float).reshape(-1, len(PATTERNS))
    toxic = np.array([r["toxic"] for r in rows_seen], float)
    repeats = np.array([r["n"] for r in rows_seen], np.int64)
    if len(set(toxic.tolist())) == 2:
        model.weights = fit_weights(np.repeat(counts, repeats, axis=0), np.repeat(toxic, repeats))
    return model


def _counted(docs: DataFrame, model: Model, kept: str) -> DataFrame:
    """Column ``text`` replaced by ``counts`` of matched clauses, other columns as in ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in _texts(batches):
            others = [c for c in batch.schema.names if c != "text"]
            counts = pa.array([shared.value.clauses(t.decode()) for t in part], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), counts], [*others, "counts"])

    return docs.mapInArrow(run, f"{kept}, counts array<int>")


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``_score``; its columns must be ``row`` and ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in _texts(batches):
            scores = shared.value.scores(np.array([shared.value.clauses(t.decode()) for t in part]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "_score"])

    return docs.mapInArrow(run, docs.select("*", F.lit(None).cast("double").alias("_score")).schema)


def toxicity(docs: DataFrame, labels: DataFrame, learn: Callable | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs``."""
    narrow = docs.select("doc_id", "text")
    scored = score_texts(narrow, fit(narrow, labels.select("doc_id", "toxic"), learn, rows))
    return scored.select("doc_id", F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def harmless_documents(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score below the threshold, with their columns."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("row"), F.col(text_col).alias("text"))
    kept = score_texts(packed, model).where(F.col("_score") < threshold)
    return kept.select(*(F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def learnable(fold_of: int = 3, held: int = 1) -> Callable:
    """Rows outside the held-out fold."""
    return lambda name: F.pmod(id_crc(name), F.lit(fold_of)) != held


def expected_score(weights: np.ndarray, counts: Sequence[int]) -> float:
    """The score of one document's counts, term by term; for tests."""
    return 1 / (1 + math.exp(-(weights[0] + sum(w * math.log2(1 + c) for w, c in zip(weights[1:], counts, strict=True)))))
