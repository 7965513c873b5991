"""Lexical search against a plain loop, and the sharing of its DAG."""

from __future__ import annotations

import math
import random
import re

import numpy as np

from modeforge.llm import lexsearch


def plain(docs, items, top=lexsearch.TOP):
    def terms(text):
        return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))

    lists = [(i, terms(t)) for i, t in docs]
    lists = [(i, t) for i, t in lists if t]
    n, length = len(lists), sum(len(t) for _, t in lists)
    asked = {}
    for name, text in items:
        asked.setdefault(name, set()).update(terms(text))
    out = []
    for name, own in asked.items():
        found = []
        for doc_id, words in lists:
            score = 0
            for t in own:
                df, tf = sum(t in w for _, w in lists), words.count(t)
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) if df else 0
                score += w * ((1_000_000_000 * tf) // (1000 * tf + 20 * (50 + (50 * len(words) * n) // length)))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(name, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_equals_a_plain_loop(spark, monkeypatch):
    rng = random.Random(5)
    words = ["Haus", "haus", "été", "x1", "İ", "THE", "the", "a_b", "日本", "zz", "and", "of", "K"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 30))) for _ in range(120)] + [None, "", "?!", "haus " * 5000]
    docs = [(rng.randrange(90) if rng.random() > 0.1 else None, t) for t in texts]
    items = [(rng.randrange(12) if k else None, " ".join(rng.choices(words, k=rng.randrange(0, 7)))) for k in range(20)] + [(99, None), (98, "?"), (97, "nowhere")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    its = spark.createDataFrame(items, "item_id long, text string")
    expected = plain(docs, items, 7)
    assert rows_of(lexsearch.search(df, its, top=7)) == expected
    # Blocks and passes change nothing.
    monkeypatch.setattr(lexsearch, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(lexsearch, "CELLS", 40)
    assert rows_of(lexsearch.search(df, its, top=7, pass_terms=8)) == expected


def test_ties_at_the_last_place_go_by_id(spark):
    docs = spark.createDataFrame([((7 * k) % 500, "same words here") for k in range(500)] + [(None, "same words here"), (1000, "else")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "words"), (2, "else")], "item_id long, text string")
    found = lexsearch.search(docs.repartition(6), items).collect()
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["item_id"] == 1] == list(range(50))
    assert [(r["rank"], r["doc_id"]) for r in found if r["item_id"] == 2] == [(1, 1000)]


def test_items_share_sets_and_nodes():
    items = [[0, 1, 2, 3], [0, 1, 2, 4], [0, 1], []]
    dag = lexsearch.share(items, 6)
    assert dag.set_of[0] == dag.set_of[1] and dag.set_of[5] == -1
    # {0, 1}, {2}, {3}, {4}: four sets, four nodes; without sharing there would be ten terms to add.
    assert dag.n_sets == 4 and len(dag.parent) == 4
    doc, term, value = np.array([0, 0, 1, 1, 1]), np.array([0, 3, 1, 2, 4]), np.array([5, 7, 11, 13, 17])
    assert lexsearch.run(dag, doc, term, value, 2).tolist() == [[12, 24], [5, 41], [5, 11], [0, 0]]
