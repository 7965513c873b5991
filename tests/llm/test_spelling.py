"""Spelling variants: the composition and the whole operator against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from modeforge.llm import spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain(counts):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if v != w and one_edit(w, v)]
        form = min(near, key=lambda v: (-counts[v], v), default=None)
        if form is not None and counts[form] < spelling.TIMES * n:
            form = None
        out[w] = (n, len(near), form, counts.get(form))
    rows = set()
    for w, (n, near, form, form_n) in out.items():
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        rows.add((w, n, near, form, form_n, root))
    return rows


def test_pairs_of_an_acceptor():
    rng = random.Random(2)
    acceptors = spelling.Acceptors()
    for _ in range(200):
        size = rng.randrange(1, 6)
        longer = sorted({"".join(rng.choices("abc", k=size)) + "." for _ in range(rng.randrange(1, 20))})
        shorter = sorted({"".join(rng.choices("abc", k=size - 1)) + "." for _ in range(rng.randrange(0, 20))})
        replaced, dropped = spelling.near_pairs(longer, shorter, acceptors)
        assert sorted(map(tuple, replaced.tolist())) == [(i, k) for i, a in enumerate(longer) for k, b in enumerate(longer) if i < k and one_edit(a, b)]
        assert sorted(map(tuple, dropped.tolist())) == [(i, k) for i, a in enumerate(longer) for k, b in enumerate(shorter) if one_edit(a, b)]


def test_acceptors_are_minimal():
    acceptors = spelling.Acceptors()
    start = acceptors.add(["tap", "taps", "top", "tops"])
    # Behind "t" both letters lead to one state: t, a|o, p, (s), end.
    assert acceptors.words[start] == 4 and len(acceptors.final) == 5
    assert acceptors.add(["tap", "taps", "top", "tops"]) == start


@pytest.mark.parametrize(("parts", "heavy"), [(2, 20_000), (2, 3), (3, 20_000), (1, 20_000)])
def test_neighbours_equal_brute_force(spark, parts, heavy):
    rng = random.Random(heavy + parts)
    counts = {"".join(rng.choices("abé", k=rng.randrange(5, 9))): rng.randrange(3, 40) for _ in range(400)}
    long = "".join(rng.choices("xyz", k=3000))
    counts |= {long: 9, long[:1500] + long[1501:]: 4, long + "q": 30, long[:-1] + "é": 3}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {(r["word"], r["n_near"], r["form"], r["form_n"]) for r in spelling.neighbours(words, parts, heavy).collect()}
    expected = set()
    for w in counts:
        near = [v for v in counts if one_edit(w, v)]
        if near:
            form = min(near, key=lambda v: (-counts[v], v))
            expected.add((w, len(near), form, counts[form]))
    assert found == expected


def test_whole_texts_against_brute_force(spark):
    rng = random.Random(9)
    vocab = ["".join(rng.choices("AabÀé÷", k=rng.randrange(3, 8))) for _ in range(60)]
    docs = [(k if k % 9 else None, " ".join(rng.choices(vocab, k=60)) + "1x-Straße") for k in range(60)] + [(7, None), (8, ""), (3, "tower Tower TOWER towers " * 50)]
    counts = Counter()
    for doc_id, text in docs:
        runs, run = [], ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "\x80" else c
            elif run:
                runs.append(run)
                run = ""
        for run in runs:
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = spelling.variants(df).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert {tuple(r) for r in found} == plain(counts) and len(found) == len(counts)


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(40)] + [(f"x{k}", "w39") for k in range(50)], "word string, form string")
    found = spelling.roots(forms).agg(F.count_distinct("root"), F.min("root"), F.count("*")).first()
    assert tuple(found) == (1, "w40", 90)
    assert spelling.roots(forms.limit(0)).count() == 0
