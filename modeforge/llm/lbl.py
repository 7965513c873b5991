"""Language-model scores: a log-bilinear neural model trained by noise-contrastive estimation.

Units are the most frequent words and, for all others, buckets by their last two bytes. The model
predicts a unit from the one before it: ``s(c, w) = r_c . q_w + b_w``. Its context is one unit long, so
the counts of pairs over the whole training corpus, which Spark sums, are all that training needs: the
noise-contrastive objective and its gradient are computed over every pair, with the expectation over
noise in place of samples. Products of the factor matrices give all scores of all contexts at once,
normalised to log-probabilities. A word in a bucket has its share of the bucket's counts besides.

What is broadcast has fixed greatest size: factors, and the counts of the most frequent words. Other
words are joined with their counts by a shuffle, after each document's repetitions are summed.

Defined cases: a null text is empty and has one token, its end; rows of equal id are scored
separately; without training rows every count is 0 and the model is uniform; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeforge.llm.common import chunks, id_crc, staged

UNITS, BUCKETS, SIZE = 1024, 256, 32
HEAD = UNITS - BUCKETS
#: Words whose counts are broadcast: at most so many, of at most so many bytes.
HOT_WORDS, HOT_BYTES = 1 << 18, 64
NOISE = 10
STEPS, RATE, DECAY = 200, 0.05, 1e-7
#: Entries of a task's table of counts before it is handed on, and bytes of text it splits at a time:
#: words as objects take some eight times their text.
TABLE, PIECE = 200_000, 1 << 20
END = b""


def bucket_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % BUCKETS


def _bucket(word: Column) -> Column:
    return F.pmod(F.crc32(F.substring(word, -2, 2)), F.lit(BUCKETS)).cast("int")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Lower-cased words of every text and its end; bytes.lower and split know ASCII only."""
    for batch in batches:
        for first, part in chunks((t.as_py().encode() if t.is_valid else b"" for t in batch.column("text")), PIECE):
            yield batch.slice(first, len(part)), [[*t.lower().split(), END] for t in part]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    counts: Counter[bytes] = Counter()
    for _, texts in _tokens(batches):
        for words in texts:
            counts.update(words)
        if len(counts) > TABLE:
            yield emit(counts)
            counts = Counter()
    if counts:
        yield emit(counts)


class Words:
    """Counts and units of the frequent words; the first ``HEAD`` have a unit of their own."""

    def __init__(self, words: list[bytes], counts: np.ndarray) -> None:
        self.place = {w: i for i, w in enumerate(words)}
        self.counts = np.append(np.asarray(counts, np.int64), 0)
        head = min(HEAD, len(words))
        tail = [HEAD + bucket_of(w) for w in words[head:]]
        self.units = np.array([*range(head), *tail, 0], np.int32)

    def find(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Place of each token of all texts in turn (-1: not here), and its unit."""
        total = sum(map(len, texts))
        place = np.fromiter((p for words in texts for p in map(self.place.get, words, repeat(-1))), np.int64, total)
        units = self.units[place]
        cold = np.flatnonzero(place < 0)
        if len(cold):
            flat = [w for words in texts for w in words]
            units[cold] = [HEAD + bucket_of(flat[i]) for i in cold.tolist()]
        return place, units


def previous(units: np.ndarray, ends: np.ndarray, end_unit: int) -> np.ndarray:
    """The unit before each token; before a text stands an end."""
    before = np.empty_like(units)
    before[1:] = units[:-1]
    before[np.append(0, ends[:-1])] = end_unit
    return before


class LogBilinear:
    """Context factors, word factors and biases."""

    def __init__(self, context: np.ndarray, word: np.ndarray, bias: np.ndarray) -> None:
        self.context, self.word, self.bias = context, word, bias
        self._table: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {"context": self.context, "word": self.word, "bias": self.bias, "_table": None}

    def log10(self) -> np.ndarray:
        """Log-probabilities of all units after all units; every row is normalised."""
        if self._table is None:
            scores = self.context.astype(float) @ self.word.T.astype(float) + self.bias
            top = scores.max(axis=1, keepdims=True)
            scores -= top + np.log(np.exp(scores - top).sum(axis=1, keepdims=True))
            self._table = (scores / np.log(10)).astype(np.float32)
        return self._table


def train(pairs: np.ndarray, steps: int = STEPS, size: int = SIZE, seed: int = 11) -> LogBilinear:
    """Noise-contrastive estimation over a matrix of pair counts (context, word)."""
    count = len(pairs)
    total = max(1.0, float(pairs.sum()))
    noise = (pairs.sum(axis=0) + 0.5) / (total + 0.5 * count)
    data = (pairs / total).astype(np.float32)
    drawn = np.outer(data.sum(axis=1), NOISE * noise).astype(np.float32)
    shift = np.log(NOISE * noise).astype(np.float32)
    rng = np.random.default_rng(seed)
    theta = [
        rng.normal(0, 0.1, (count, size)).astype(np.float32), rng.normal(0, 0.1, (count, size)).astype(np.float32), np.log(noise).astype(np.float32),
    ]
    first, second = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta]
    for step in range(1, steps + 1):
        context, word, bias = theta
        is_data = 1 / (1 + np.exp(np.clip(shift - (context @ word.T + bias), -80, 80)))
        slope = data - (data + drawn) * is_data
        slopes = [slope @ word - DECAY * context, slope.T @ context - DECAY * word, slope.sum(axis=0)]
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, s, a, b in zip(theta, slopes, first, second, strict=True):
            a += 0.1 * (s - a)
            b += 0.01 * (s * s - b)
            p += rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-10)
    return LogBilinear(*theta)


def _frequent(counts: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """Frequent words with counts, the most frequent first: all of at least some count, within the bound."""
    short = counts.where(F.length("word") <= HOT_BYTES)
    steps = F.floor(F.log2("n") * 16)
    levels = sorted(((r["level"], r["words"]) for r in short.groupBy(steps.alias("level")).agg(F.count("*").alias("words")).collect()), reverse=True)
    least, words = None, 0
    for level, more in levels:
        words += more
        if words > HOT_WORDS:
            break
        least = level
    if least is None:
        return [], np.zeros(0, np.int64)
    rows = short.where(steps >= least).toPandas().sort_values(["n", "word"], ascending=[False, True])
    return [bytes(w) for w in rows["word"]], rows["n"].to_numpy(np.int64)


def held_out(of: int = 5, held: int = 1) -> Column:
    return F.pmod(id_crc(), F.lit(of)) == held


def score_documents(docs: DataFrame, training: Column | None = None) -> DataFrame:
    """Scores of all ``docs(doc_id, text)``, learnt from the rows where ``training`` holds.

    ``row, doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every row.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    learnt = docs.where(training if training is not None else F.lit(True)).select("text")
    counts = staged(learnt.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = totals["n"], totals["v"]
    words, hot = _frequent(counts)
    shared = sc.broadcast(Words(words, hot))
    head = spark.createDataFrame([(bytearray(w),) for w in words[:HEAD]], "word binary")
    buckets = (
        counts.join(F.broadcast(head), "word", "left_anti")
        .groupBy(_bucket(F.col("word")).alias("bucket"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("v"))
        .collect()
    )
    sums = np.full(BUCKETS, 0.5)
    for r in buckets:
        sums[r["bucket"]] = r["n"] + 0.5 * (r["v"] + 1)
    end_unit = int(shared.value.units[shared.value.place.get(END, -1)])

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(UNITS * UNITS, np.int64)
        for _, texts in _tokens(batches):
            _, units = shared.value.find(texts)
            before = previous(units, np.cumsum([len(t) for t in texts]), end_unit)
            table += np.bincount(before.astype(np.int64) * UNITS + units, minlength=UNITS * UNITS)
        some = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(table[some])], ["pair", "n"])

    summed = learnt.mapInArrow(count_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    pairs = np.zeros(UNITS * UNITS)
    pairs[summed["pair"]] = summed["n"]
    model = sc.broadcast(train(pairs.reshape(UNITS, UNITS)))
    base_sum, cold_lists = tokens + 0.5 * (distinct + 1), pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value.log10()
        known = shared.value
        for batch, texts in _tokens(batches):
            place, units = known.find(texts)
            sizes = np.array([len(t) for t in texts])
            ends = np.cumsum(sizes)
            starts = ends - sizes
            before = previous(units, ends, end_unit)
            n = known.counts[place]
            is_hot = place >= 0
            base = np.where(is_hot, np.log10((n + 0.5) / base_sum), 0.0)
            own = table[before, units].astype(float)
            tail = is_hot & (units >= HEAD)
            own[tail] += np.log10((n[tail] + 0.5) / sums[units[tail] - HEAD])
            cold: list[list[dict]] = []
            unknown = np.flatnonzero(~is_hot)
            cuts = np.searchsorted(unknown, np.append(starts, ends[-1]))
            for words, start, a, b in zip(texts, starts.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                found = Counter(words[i - start] for i in unknown[a:b].tolist())
                cold.append([{"word": w, "n": k} for w, k in found.items()])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(np.add.reduceat((n > 0).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(own, starts)), pa.array(cold, cold_lists),
                ],
                ["row", "doc_id", "n_tokens", "known", "base", "own", "cold"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kind = f"row long, doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, known long, base double, own double, cold array<struct<word: binary, n: long>>"
    scored = staged(rows.mapInArrow(score, kind), "scores")
    cold = scored.select("row", F.explode("cold").alias("x")).select("row", "x.word", F.col("x.n").alias("k"))
    in_bucket = spark.createDataFrame(list(enumerate(sums.tolist())), "bucket int, whole double")
    priced = (
        cold.join(counts, "word", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("bucket", _bucket(F.col("word")))
        .join(F.broadcast(in_bucket), "bucket")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(F.lit(0))).alias("more_known"),
            F.sum(F.col("k") * F.log10((F.col("n") + 0.5) / F.lit(base_sum))).alias("more_base"),
            F.sum(F.col("k") * F.log10((F.col("n") + 0.5) / F.col("whole"))).alias("more_own"),
        )
    )
    zero = F.lit(0)
    return scored.drop("cold").join(staged(priced, "cold-scores"), "row", "left").select(
        "row", "doc_id", "n_tokens", (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"), F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), (F.col("own") + F.coalesce("more_own", F.lit(0.0))).alias("score"),
    )
