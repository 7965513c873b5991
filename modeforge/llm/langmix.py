"""Language of documents as a mixture, by expectation-maximisation over n-gram likelihoods.

Training counts hashed byte trigrams by language: tasks sum their rows before the shuffle, and the
driver gets one table of languages times buckets. A document is a bag of trigrams drawn from a mixture
of languages. EM estimates the proportions; then languages are dropped, the weakest first, as long as
the likelihood loses less than the penalty of half the logarithm of the document's length per
language. Documents are handled many at a time as matrices, in a narrow map without a shuffle.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and so is every text
if nothing was learnt; rows with a null language or text are not learnt from; texts of fewer than three
bytes are padded; ties go to the first language in order; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeforge.llm.common import chunks, id_crc

BUCKETS = 4096
#: Languages that can be told apart; more are an error, never dropped.
MOST_LANGUAGES = 1000
SMOOTHING = 0.5
#: A byte is in this many trigrams, so these are no independent draws.
OVERLAP = 3.0
STEPS = 8
DOCS_AT_ONCE = 128

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def bags(texts: Sequence[bytes]) -> np.ndarray:
    """Counts of hashed trigrams, a row per text; runs of what is no letter are one space."""
    joined = np.frombuffer(b"".join(b" " + t + b"  " for t in texts), np.uint8)
    folded = _FOLD[joined]
    owner = np.repeat(np.arange(len(texts)), [len(t) + 3 for t in texts])
    keep = np.append(True, (folded[1:] != 32) | (folded[:-1] != 32) | (owner[1:] != owner[:-1]))
    folded, owner = folded[keep], owner[keep]
    if len(folded) < 3:
        return np.zeros((len(texts), BUCKETS), np.float32)
    code = (folded[:-2] << 16) | (folded[1:-1] << 8) | folded[2:]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
    inside = owner[:-2] == owner[2:]
    cells = np.bincount(owner[:-2][inside] * BUCKETS + bucket[inside], minlength=len(texts) * BUCKETS)
    return cells.reshape(len(texts), BUCKETS).astype(np.float32)


class LanguageModel:
    """Trigram distributions of the languages."""

    def __init__(self, languages: Sequence[str], counts: np.ndarray) -> None:
        self.languages = list(languages)
        smooth = counts.astype(float) + SMOOTHING
        self.table = (smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)

    def _em(self, bag: np.ndarray, shares: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Proportions after some steps from ``shares`` (zeros stay zero), and the log-likelihood."""
        n = np.maximum(bag.sum(axis=1, keepdims=True), 1)
        for _ in range(steps):
            shares = shares * ((bag / np.maximum(shares @ self.table, 1e-30)) @ self.table.T) / n
            shares = shares / np.maximum(shares.sum(axis=1, keepdims=True), 1e-30)
        fit = (bag * np.log(np.maximum(shares @ self.table, 1e-30))).sum(axis=1, dtype=float)
        return shares, fit

    def shares(self, bag: np.ndarray) -> np.ndarray:
        """Proportions of the selected languages, a row per document."""
        docs, count = len(bag), len(self.languages)
        shares, fit = self._em(bag, np.full((docs, count), 1 / count, np.float32), STEPS)
        penalty = 0.5 * np.log(np.maximum(bag.sum(axis=1), 2) / OVERLAP + 1)

        def attempt(rows: np.ndarray, reduced: np.ndarray) -> np.ndarray:
            """Take smaller sets where the penalised likelihood does not fall; which rows did."""
            dropped = (shares[rows] > 0).sum(axis=1) - (reduced > 0).sum(axis=1)
            reduced = reduced / np.maximum(reduced.sum(axis=1, keepdims=True), 1e-30)
            new, value = self._em(bag[rows], reduced, STEPS // 2)
            better = (fit[rows] - value) / OVERLAP <= penalty[rows] * dropped
            shares[rows[better]], fit[rows[better]] = new[better], value[better]
            return better

        # All faint languages at once, then one at a time.
        faint = (shares < 0.02) & (shares < shares.max(axis=1, keepdims=True))
        rows = np.flatnonzero(faint.any(axis=1))
        if len(rows):
            attempt(rows, np.where(faint[rows], 0, shares[rows]))
        rows = np.flatnonzero((shares > 0).sum(axis=1) > 1)
        while len(rows):
            reduced = shares[rows].copy()
            weakest = np.where(reduced > 0, reduced, 2).argmin(axis=1)
            reduced[np.arange(len(rows)), weakest] = 0
            rows = rows[attempt(rows, reduced)]
            rows = rows[(shares[rows] > 0).sum(axis=1) > 1]
        return shares


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for first, part in chunks(t.as_py().encode() if t.is_valid else b"" for t in batch.column("text")):
            for i in range(0, len(part), DOCS_AT_ONCE):
                some = part[i : i + DOCS_AT_ONCE]
                yield batch.slice(first + i, len(some)), bags(some)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch, bag in _batches(batches):
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in set(langs.tolist()):
            sums[lang] = sums.get(lang, 0) + bag[langs == lang].sum(axis=0, dtype=float)
    for lang, total in sums.items():
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(total[some].astype(np.int64))], ["lang", "bucket", "n"]
        )


def learn(docs: DataFrame) -> LanguageModel | None:
    """The model of ``docs(text, lang)``; None if there is nothing to learn from."""
    known = docs.where("lang is not null and text is not null").select("text", "lang")
    sums = known.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # As many rows as languages times buckets.
    rows = sums.limit(MOST_LANGUAGES * BUCKETS + 1).toPandas()
    languages = sorted(rows["lang"].unique())
    if len(rows) > MOST_LANGUAGES * BUCKETS or len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not languages:
        return None
    counts = np.zeros((len(languages), BUCKETS))
    counts[np.searchsorted(languages, rows["lang"]), rows["bucket"]] = rows["n"]
    return LanguageModel(languages, counts)


def languages_of(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, mixture`` for every row; mixture lists languages and shares."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    empty = F.expr("cast(array() as array<struct<lang: string, share: double>>)")
    if model is None:
        return narrow.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), empty.alias("mixture"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value.languages
        for batch, bag in _batches(batches):
            shares = shared.value.shares(bag).astype(float)
            best = shares.argmax(axis=1)
            mixture = [[{"lang": names[j], "share": row[j]} for j in np.flatnonzero(row).tolist()] for row in shares]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("letters"), pa.array([names[j] for j in best], pa.string()),
                    pa.array(np.clip(shares[np.arange(len(best)), best], 0, 1)), pa.array(mixture, kind),
                ],
                ["doc_id", "letters", "lang", "share", "mixture"],
            )

    found = narrow.mapInArrow(run, f"doc_id {dict(narrow.dtypes)['doc_id']}, letters boolean, lang string, share double, mixture array<struct<lang: string, share: double>>")
    return found.select(
        "doc_id",
        F.when(F.col("letters"), F.col("lang")).otherwise(F.lit("und")).alias("lang_pred"),
        F.when(F.col("letters"), F.col("share")).otherwise(F.lit(0.0)).alias("score"),
        F.when(F.col("letters"), F.col("mixture")).otherwise(empty).alias("mixture"),
    )


def held_out(of: int = 4, held: int = 2) -> Column:
    return F.pmod(id_crc(), F.lit(of)) == held
