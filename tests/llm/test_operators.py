"""Operators against brute force, hand-made cases and held-out accuracy."""

from __future__ import annotations

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from modeforge.llm import decontam, exactdup, fragjoin, hashtree, langmix, lbl, mixing, toolcalls, toxgrammar, urlbloom
from modeforge.llm.common import components, staged, table
from modeforge.llm.shingles import shingle_sets

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def docs_of_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# --- tool calls


def test_levels_and_cycles(spark):
    rows = [("a", []), ("b", ["a"]), ("c", ["a", "b"]), ("x", ["y"]), ("y", ["x"]), ("z", ["x"]), ("d", ["c", "gone"])]
    calls = spark.createDataFrame(
        [(1, n, i, "search", '{"query": "q", "limit": 3}', deps) for i, (n, deps) in enumerate(rows)],
        "conv_id long, call_id string, turn long, name string, arguments string, after array<string>",
    )
    results = spark.createDataFrame([(1, "a", 5, "r"), (1, "a", 4, "first"), (1, "q", 9, "lost")], "conv_id long, call_id string, turn long, content string")
    found = {r["call_id"]: r for r in toolcalls.link_calls(calls, results).collect()}
    assert {k: found[k]["level"] for k in "abcdxyz"} == {"a": 0, "b": 1, "c": 2, "d": 3, "x": None, "y": None, "z": None}
    assert found["x"]["errors"] == "cycle" and found["d"]["errors"] == "1 unknown dependencies"
    assert found["a"]["status"] == "repeated result" and '"result":"first"' in found["a"]["message"]
    assert found["q"]["status"] == "no call" and found["b"]["status"] == "no result"


def test_validation_and_canonical_json():
    rules = toolcalls.TOOLS["search"]
    assert toolcalls.violations({"query": "", "limit": True, "more": 1}, rules) == ["limit: not integer", "more: unknown", "query: too short"]
    assert toolcalls.violations(toolcalls.parsed("[1]"), rules) == ["no object"]
    assert toolcalls.violations({}, None) == ["unknown tool"]
    assert toolcalls.parsed('{"a": NaN}') is None
    assert toolcalls.canonical_json({"b": [1.5, "é\n"], "a": None}) == '{"a":null,"b":[1.5,"é\\n"]}'


# --- language


def test_language_of_held_out_documents_and_mixtures(spark):
    docs = table(spark, MEDIUM, "documents")
    model = langmix.learn(docs.where(~langmix.held_out()))
    found = langmix.languages_of(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(langmix.held_out())
    right, total = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.97 * total
    pure = {r["lang"]: r["text"] for r in docs.where(F.length("text") > 3000).groupBy("lang").agg(F.min("text").alias("text")).collect()}
    mixed = docs_of(spark, [pure["en"][:2000] + " " + pure["de"][:1000], pure["fr"][:3000]])
    two, one = (r["mixture"] for r in langmix.languages_of(mixed, model).orderBy("doc_id").collect())
    assert {x["lang"] for x in two} == {"en", "de"} and [x["lang"] for x in one] == ["fr"]
    assert next(x["share"] for x in two if x["lang"] == "en") == pytest.approx(2 / 3, abs=0.1)


def test_em_never_lowers_the_likelihood():
    rng = np.random.default_rng(1)
    model = langmix.LanguageModel(["a", "b", "c"], rng.integers(0, 50, (3, langmix.BUCKETS)))
    bag = rng.integers(0, 3, (5, langmix.BUCKETS)).astype(np.float32)
    shares = np.full((5, 3), 1 / 3, np.float32)
    last = None
    for _ in range(6):
        shares, fit = model._em(bag, shares, 1)
        assert last is None or (fit >= last - 1e-2).all()
        last = fit


# --- log-bilinear model


def test_scores_equal_a_plain_count(spark, monkeypatch):
    monkeypatch.setattr(lbl, "HOT_WORDS", 300)
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    rows = docs.collect()
    out = {r["doc_id"]: r for r in lbl.score_documents(docs, ~lbl.held_out()).collect()}
    counts = {}
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1 for r in rows}
    tokens = {r["doc_id"]: [*(r["text"] or "").encode().lower().split(), b""] for r in rows}
    for i, words in tokens.items():
        for w in words if not held[i] else []:
            counts[w] = counts.get(w, 0) + 1
    whole, distinct = sum(counts.values()), len(counts)
    for i, words in tokens.items():
        base = sum(np.log10((counts.get(w, 0) + 0.5) / (whole + 0.5 * (distinct + 1))) for w in words)
        assert out[i]["base_score"] == pytest.approx(base, rel=1e-9)
        assert out[i]["n_tokens"] == len(words) and out[i]["n_known"] == sum(w in counts for w in words)
        assert out[i]["train_tokens"] == whole
    gain = sum(out[i]["score"] - out[i]["base_score"] for i in out if held[i])
    assert gain > 0


def test_training_finds_the_conditional_distribution():
    rng = np.random.default_rng(2)
    truth = rng.dirichlet(np.full(12, 0.3), 12)
    pairs = np.round(truth * 1e5)
    model = lbl.train(pairs, steps=800, size=12)
    got = 10 ** model.log10().astype(float)
    assert got.sum(axis=1) == pytest.approx(np.ones(12), abs=1e-5)
    assert np.abs(got - truth).max() < 0.05


# --- hash tree


def test_growth_moves_rows_only_into_the_new_shard(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = hashtree.place(docs).collect()
    assert all(r["grown_shard"] in (r["shard"], 16) for r in rows)
    moved = sum(r["grown_shard"] == 16 for r in rows)
    assert 150 < moved < 330
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_slots_of_a_hot_id_and_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(hashtree, "AT_ONCE", 100)
    rows = [(None, f"text {i}") for i in range(900)] + [(5, "same")] * 750 + [(i, "x") for i in range(500)]
    found = hashtree.place(docs_of_rows(spark, rows)).collect()
    assert len(found) == len(rows)
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Rows without an id share a shard, but not one part of its order.
    hot = sorted(r["slot"] for r in found if r["doc_id"] is None)
    size = len(slots[next(r["shard"] for r in found if r["doc_id"] is None)])
    assert hot[0] < size / 5 and hot[-1] > size * 4 / 5


def test_more_weight_in_a_rack_only_draws_rows_there(spark):
    tree = hashtree.regular_tree(8, racks=2, per_rack=2)
    heavier = [t._replace(weight=3.0) if t.shard == 2 else t for t in tree]
    ids = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    rows = ids.select(hashtree.shard_of(F.col("k"), tree).alias("a"), hashtree.shard_of(F.col("k"), heavier).alias("b")).where("a <> b").collect()
    region = {t.shard: t.region for t in tree}
    rack = {t.shard: (t.region, t.rack) for t in tree}
    assert rows
    for r in rows:
        assert region[r["b"]] == "region0"
        if region[r["a"]] == "region0":
            assert rack[r["b"]] == rack[2]


# --- URLs


def test_no_listed_key_is_missed_and_few_others_pass(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("u site"), "id").alias("key"))
    listed, others = keys.where("hash(key) % 4 = 0"), keys.where("hash(key) % 4 <> 0")
    n = listed.count()
    blocks = urlbloom.block_count(n)
    bloom = urlbloom.bloom_blocks(listed, blocks)
    assert urlbloom.possible_hits(listed, bloom, blocks).count() == n
    assert urlbloom.possible_hits(others, bloom, blocks).count() < 0.02 * others.count()


def test_rules_and_list(spark):
    urls = [
        "http://A.B.NET/x", "http://net/y", "http://sub.example.net/en/1", "http://xnet/", "http://example.net", "https://www.other.org/p/?utm_source=f&b=2&a=1#z",
        "https://other.org/p?a=1&b=2", "http://de.example.com/de/q", "http://b.org/fr/",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame([("http://other.org/p?b=2&a=1",)], "url string")
    got = [(r["rule"], r["verdict"], r["listed"]) for r in urlbloom.filter_urls(pages, listed).orderBy("page_id").collect()]
    assert got == [
        ("net/", "block", False), ("net/", "block", False), ("example.net/en/", "allow", False), (None, "allow", False), (None, "allow", False),
        (None, "block", True), (None, "block", True), ("example.com/de/", "block", False), ("org/fr/", "allow", False),
    ]


# --- exact duplicates


def test_collisions_are_split_by_bytes(spark):
    texts = ["one", " o n e ", "two", "two", "three", None, ""]
    weak = lambda c: F.unhex(F.lit("00"))
    rows = exactdup.exact_duplicates(docs_of(spark, texts), hash_of=weak, check_of=lambda c: F.lit("same")).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in rows} == {
        0: (1, 2, False), 1: (1, 2, True), 2: (2, 2, True), 3: (2, 2, False), 4: (4, 1, True), 5: (5, 2, True), 6: (5, 2, False),
    }
    assert sorted(r["doc_id"] for r in exactdup.unique_documents(docs_of(spark, texts)).collect()) == [1, 2, 4, 5]


# --- decontamination


def test_automaton_equals_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        letters = "abcd"[: rng.randint(1, 4)]
        items = [(k, " ".join(rng.choice(letters) for _ in range(rng.randint(0, 9)))) for k in range(rng.randint(0, 4))]
        window = rng.randint(1, 4)
        texts = [" ".join(rng.choice(letters + "z") for _ in range(rng.randint(0, 25))) for _ in range(5)]
        found = decontam.Windows([(str(a), b.encode()) for a, b in items], window).scan([t.encode() for t in texts])
        for text, (n, spans, names) in zip(texts, found, strict=True):
            hit = {i for a, b in spans for i in range(a, b)}
            assert (n, len(hit), sorted(names)) == decontam.brute_force(text, items, window)[:3]


def test_items_in_several_blocks_and_cutting(spark):
    docs = docs_of(spark, ["x y one two three z w", "clean text", None])
    items = spark.createDataFrame([(1, "One, two three"), (2, "two THREE z"), (3, "q")], "item_id long, text string")
    for block in (1, 1000):
        rows = decontam.contamination(docs, items, block_words=block).orderBy("doc_id").collect()
        assert [(r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows] == [(7, 4, ["1", "2"], True), (2, 0, [], False), (0, 0, [], False)]
        kept = decontam.clean_documents(docs, items, one_in=1, cut_spans=True, block_words=block).orderBy("doc_id").collect()
        assert [r["text"] for r in kept] == ["x y  w", "clean text", None]
    assert decontam.clean_documents(docs, items).count() == 2


# --- near duplicates


def brute_components(texts):
    sets = shingle_sets([(t or "").encode() for t in texts], fragjoin.WIDTH)
    root = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if n and 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_components_of_copies_chains_and_shared_passages(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    passage = [rng.choice(words) for _ in range(60)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(3, 150))]
        for _ in range(rng.randint(1, 25)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy if rng.random() < 0.7 else [*copy, *passage]))
    slide = [rng.choice(words) for _ in range(300)]
    texts += [" ".join(slide[i * 8 : i * 8 + 100]) for i in range(20)] + [None, "", "one two", "One  two"]
    rng.shuffle(texts)
    expected = brute_components(texts)
    rows = fragjoin.near_duplicates(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r["component_id"] for r in rows] == expected
    kept = sorted(r["doc_id"] for r in fragjoin.one_of_each(docs_of(spark, texts)).collect())
    assert kept == [i for i, c in enumerate(expected) if c == i]


def test_least_common_shingles_of_prefixes(spark):
    """Whatever two sets link, their prefixes share as many shingles as the join relies on."""
    sizes = [(a, b) for a in (1, 2, 5, 9, 33, 80, 396) for b in (1, 2, 4, 5, 9, 30, 33, 70, 80, 330, 396, 480)]
    df = spark.createDataFrame([({"n": a}, {"n": b}) for a, b in sizes], "x struct<n: long>, y struct<n: long>")
    least = [r[0] for r in df.select(fragjoin._least_common(F.col("x"), F.col("y"))).collect()]
    rng = np.random.default_rng(3)
    for (a, b), l in zip(sizes, least, strict=True):
        overlap = -(-80 * (a + b) // 180)
        if overlap > min(a, b):
            continue
        for _ in range(30):
            # Two sets in one order with the least overlap that links.
            order = rng.permutation(a + b - overlap)
            both, mine = set(order[:overlap].tolist()), set(order[overlap : overlap + a - overlap].tolist())
            theirs = set(order[a:].tolist())
            x, y = sorted(both | mine), sorted(both | theirs)
            assert len(x) == a and len(y) == b
            heads = (set(s[: len(s) - fragjoin._needed(len(s)) + 1]) for s in (x, y))
            assert len(set.intersection(*heads)) >= l


def test_dense_groups_with_near_misses(spark):
    """Copies with few and with many changes, of sizes around the threshold, against all pairs."""
    rng = random.Random(12)
    texts = []
    for size in (30, 60, 200):
        base = [f"w{size}x{i}" for i in range(size)]
        for k in range(60):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
                words[rng.randrange(len(words))] = rng.choice([f"n{k}", "usual", f"f{k % 5}"])
            texts.append(" ".join(words[: rng.choice([len(words), len(words), len(words) - size // 20])]))
    rng.shuffle(texts)
    found = {r["doc_id"]: r["component_id"] for r in fragjoin.near_duplicates(docs_of(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == brute_components(texts)


def test_unlike_texts_without_own_ids_all_stay(spark):
    def text(name, n=12):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [(None, text("a")), (None, text("b")), (None, text("c")), (None, text("A")), (5, text("d")), (5, text("e")), (6, text("f")), (7, text("f")), (None, text("f")), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["doc_id"] or 0, (r["text"] or "").lower()) for r in fragjoin.one_of_each(docs).collect())
    assert kept == [(0, ""), (0, text("a")), (0, text("b")), (0, text("c")), (5, text("d")), (5, text("e")), (6, text("f"))]


def test_memory_of_tasks_that_make_shingles(spark, monkeypatch):
    # Of text that a task gets at a time.
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}
    before, staged_before = spark.conf.get(name), fragjoin.staged

    def watched(df, label):
        seen[label] = spark.conf.get(name)
        return staged_before(df, label)

    monkeypatch.setattr(fragjoin, "staged", watched)
    fragjoin.near_duplicates(docs_of(spark, ["a b c d e f", "a b c d e f g"]))
    assert all(0 < int(seen[label]) <= 8 << 20 for label in ("shingle-counts", "sets"))
    assert seen["classes"] == spark.conf.get(name) == before
    # Of the numbers it makes of them, with the same counts as a plain loop.
    words = [f"w{i:06x}" for i in np.random.default_rng(1).integers(0, 1 << 24, 2_200_000)]
    texts = [" ".join(words[i : i + 2200]) for i in range(0, len(words), 2200)]
    batches = [pa.RecordBatch.from_pydict({"text": texts[i : i + 100]}) for i in range(0, len(texts), 100)]
    tracemalloc.start()
    try:
        parts = list(fragjoin._count_parts(6)(iter([*batches, batches[0]])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 72 << 20
    totals = Counter()
    for part in parts:
        for row in part.to_pylist():
            totals.update((row["range"], k) for k in np.frombuffer(row["ones"], np.uint32).tolist())
            more = np.frombuffer(row["more"], np.uint32).tolist()
            for k, n in zip(more, np.frombuffer(row["counts"], np.uint32).tolist(), strict=True):
                totals[row["range"], k] += n
    plain = Counter()
    for own in shingle_sets([t.encode() for t in [*texts, *texts[:100]]], fragjoin.WIDTH):
        plain.update((v >> 58, (v >> 26) & 0xFFFFFFFF) for v in own.tolist())
    assert totals == plain


def test_memory_of_the_driver_that_holds_the_order(spark, monkeypatch):
    # The bitmap alone has 16 MB, however few of its bits are set.
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 64, 3000, dtype=np.uint64)) for _ in range(9)]
    sets += [sets[0]] * 12 + sets[1:5]
    monkeypatch.setattr(fragjoin, "_text_batches", lambda batches: ((b, sets) for b in batches))
    parts = pa.Table.from_batches(fragjoin._count_parts(4)(iter([None]))).to_pandas()
    rows = [r for _, part in parts.groupby("range") for r in fragjoin._sum_parts(4)(part).to_dict("records")]
    assert sum(len(r["keys"]) for r in rows) < 1 << 20
    order = fragjoin.Order(4, rows)
    shared, level = order.marks(sets[0])
    assert shared.all() and (level == 3).all()
    shared, level = order.marks(sets[1])
    assert shared.all() and not level.any()
    assert not order.marks(sets[8])[0].sum() > 30
    monkeypatch.undo()
    # Nothing of it is left when its only reader has been written.
    sc, made, held = spark.sparkContext, [], {}
    broadcast, staged_before = type(sc).broadcast, fragjoin.staged

    def kept(self, value):
        made.append(broadcast(self, value))
        return made[-1]

    def watched(df, label):
        held[label] = sum(b._jbroadcast.isValid() for b in made)
        return staged_before(df, label)

    monkeypatch.setattr(type(sc), "broadcast", kept)
    monkeypatch.setattr(fragjoin, "staged", watched)
    rows = fragjoin.near_duplicates(docs_of(spark, ["a b c d e f", "a b c d e f", None, "x y"])).orderBy("doc_id").collect()
    assert [(r["n_shingles"], r["component_id"]) for r in rows] == [(2, 0), (2, 0), (0, 2), (1, 3)]
    assert held["sets"] == 1 and held["classes"] == 0


def test_survivors_do_not_depend_on_how_a_scan_is_cut(spark, monkeypatch, tmp_path):
    texts = [" ".join(f"{k % 20}w{i}" for i in range(9)) for k in range(32)]
    rows = [(k // 2 if k < 4 else None, t) for k, t in enumerate(texts)] + [(50, texts[19])] * 3
    path = str(tmp_path / "docs.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(9).write.parquet(path)
    docs = spark.read.parquet(path)
    options = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k, None) for k in options}
    staged_by = {m: m.staged for m in (fragjoin, exactdup)}

    def cut_anew(df, label):
        out = staged_by[fragjoin](df, label)
        spark.conf.set("spark.sql.files.minPartitionNum", "64")
        return out

    try:
        for keep in (fragjoin.one_of_each, exactdup.unique_documents):
            spark.conf.set("spark.sql.files.minPartitionNum", "1")
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            module = fragjoin if keep is fragjoin.one_of_each else exactdup
            monkeypatch.setattr(module, "staged", cut_anew)
            assert sorted(r["text"] for r in keep(docs).collect()) == sorted(set(texts))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_word_hashes_know_no_case_and_no_neighbour():
    a, b, c = shingle_sets([b"A b\tC d\x0be f", b"a B c D e F", b"x"], 5)
    assert (a == b).all() and len(a) == 2 and len(c) == 1
    long = b"y" * 100
    assert (shingle_sets([long + b" z"], 5)[0] == shingle_sets([b"q", long + b" z"], 5)[1]).all()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}}


# --- mixing


def test_shortages_go_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("d1", "en", "a", 10, 1), ("d1", "en", "b", 1000, 1), ("d2", "en", "a", 1000, 1)], "domain string, lang string, source string, size long, rows long"
    )
    rows = mixing.budgets(leaves, mixing.Mixture(share=0.5, max_epochs=1)).collect()
    got = {(r["domain"], r["source"]): r["granted"] for r in rows}
    # 1005 tokens: half for each domain; what source a of d1 lacks goes to its sibling b.
    assert got == {("d1", "a"): 10, ("d1", "b"): 492, ("d2", "a"): 502}


def test_mixed_rows_repeat_as_often_as_counted(spark):
    docs = table(spark, SMALL, "documents")
    mixture = mixing.Mixture(weights={"lang": {"es": 5000, "en": 0}}, share=0.4, max_epochs=3)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs, mixture).collect()}
    taken = mixing.mixed_documents(docs, mixture)
    assert taken.columns == docs.columns
    counted = {r["doc_id"]: r["count"] for r in taken.groupBy("doc_id").count().collect()}
    assert counted == {i: n for i, n in copies.items() if n} and max(copies.values()) == 3


def test_rows_of_one_or_no_id_fill_the_budget(spark):
    unlike = [(None, f"a b c{i}", "en", "src1") for i in range(50)]
    same = [(None, "x y z", "de", "src1")] * 40 + [(3, "x y z", "fr", "src1")] * 40
    docs = spark.createDataFrame([*unlike, *same], "doc_id long, text string, lang string, source string")
    for epochs, share in ((1, 0.9), (3, 1.7)):
        taken = mixing.mixed_documents(docs, mixing.Mixture(share=share, max_epochs=epochs)).collect()
        by_lang = {lang: [r["text"] for r in taken if r["lang"] == lang] for lang in ("en", "de", "fr")}
        tokens = int(4 * 130 * share)
        assert tokens - 3 * 4 < 4 * len(taken) <= tokens
        assert len(set(by_lang["en"])) == min(50, len(by_lang["en"])) and len(by_lang["de"]) == len(by_lang["fr"])
        assert all(by_lang["en"].count(t) in (int(share), int(share) + 1, int(share) + 2) for t in by_lang["en"])


def test_one_law_for_counts_and_rows(spark):
    """Rows of one or no id: the counts fill the budget as the rows do."""
    docs = [(None, f"a b c{i % 90}", "en", f"src{i % 4}") for i in range(400)] + [(9, "x y", "de", "src1")] * 60
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    for mixture in (mixing.Mixture(share=0.6, max_epochs=1), mixing.Mixture(share=1.4, max_epochs=2)):
        counted = mixing.mix(df, mixture).collect()
        assert len(counted) == len(docs)
        granted = int((400 * 4 + 60 * 3) * mixture.share)
        took = sum(r["copies"] * r["n_tokens"] for r in counted)
        assert granted - 4 * 5 < took <= granted
        leaves = {}
        for r in counted:
            leaves[r["lang"], r["source"]] = leaves.get((r["lang"], r["source"]), 0) + r["copies"]
        taken = {(r["lang"], r["source"]): r["count"] for r in mixing.mixed_documents(df, mixture).groupBy("lang", "source").count().collect()}
        assert taken == {k: n for k, n in leaves.items() if n}


def plain_shares(caps, weights, budget):
    """Water filling, one child after the other."""
    given, order = [0.0] * len(caps), sorted(range(len(caps)), key=lambda i: caps[i] / weights[i])
    left, weight = budget, sum(weights)
    for at, i in enumerate(order):
        if caps[i] / weights[i] <= left / weight:
            given[i], left, weight = float(caps[i]), left - caps[i], weight - weights[i]
        else:
            for j in order[at:]:
                given[j] = weights[j] * left / weight
            break
    return given


def test_shares_of_very_many_children(spark):
    rng = random.Random(8)
    for n, budget in ((1, 5.0), (40, 3000.0), (30_000, 4e6)):
        caps = [rng.choice([1, 7, 50, 1000, rng.randrange(1, 10**5)]) for _ in range(n)]
        weights = [rng.choice([100, 100, 300, 7]) for _ in range(n)]
        for b in (0.0, budget, float(sum(caps))):
            rows = [("p", f"{i:06d}", c, w, b) for i, (c, w) in enumerate(zip(caps, weights, strict=True))]
            children = spark.createDataFrame(rows, "parent string, child string, cap long, weight long, budget double")
            got = [r["given"] for r in mixing.share_out(children, ["parent"], "child").orderBy("child").collect()]
            assert got == pytest.approx(plain_shares(caps, weights, b), rel=1e-9)


# --- toxicity


def test_grammar():
    model = toxgrammar.Model(frozenset({"idio", "moro"}))

    def pattern(text):
        counts = model.clauses(text)
        return [toxgrammar.PATTERNS[i] for i, n in enumerate(counts) for _ in range(n)]

    assert pattern("What an idiot") == ["insult"]
    assert pattern("you are an idiot") == ["aimed insult"] and pattern("idiot, you") == ["aimed insult"]
    assert pattern("not an idiot") == ["negated"] and pattern("not one of the many idiots") == ["insult"]
    assert pattern("he said idiot") == ["reported"] and pattern("she said it. idiot") == ["insult"]
    assert pattern("kill them; a moron") == ["insult", "aimed threat"]
    assert pattern("The idyll. Morning") == [] and pattern("") == []
    # Forms of verbs, contractions, and verbs of speech behind what was said.
    assert pattern("I will be killing them") == ["aimed threat"] and pattern("he kills you") == ["aimed threat"]
    assert pattern("we killed him") == ["aimed threat"] and pattern("you deserve to be shot") == ["threat"]
    assert pattern("don't kill him") == ["negated"] and pattern("You aren’t an idiot!") == ["negated"]
    assert pattern('"idiot", she said') == ["reported"] and pattern('"idiot"; she said') == ["insult"]
    assert pattern("l'idiot") == ["insult"] and pattern("a t-shirt isn't it") == []
    assert model.scores(np.array([[0, 0, 1, 0, 0, 0]]))[0] == pytest.approx(toxgrammar.expected_score(model.weights, [0, 0, 1, 0, 0, 0]))


def slow_clauses(model, text):
    """The patterns of every clause, word by word, without a transducer."""
    counts = [0] * len(toxgrammar.PATTERNS)
    for clause in re.split(r"[.!?;\n]", text.lower()):
        classes = [model.word_class(w) for w in re.findall(r"[^\W\d_]+n['’]t(?![^\W\d_])|[^\W\d_]+", clause)]
        said = {i for i, c in enumerate(classes) if c == "report"}
        found = []
        for i, c in enumerate(classes):
            if c not in ("insult", "threat"):
                continue
            # A negation reaches over three words, and a later one begins anew.
            if any(classes[j] == "negation" for j in range(max(0, i - 3), i)):
                name = "negated"
            elif any(j < i for j in said):
                name = "reported"
            else:
                before = any(classes[j] == "target" for j in range(max(0, i - 3), i))
                # The last match alone waits for a target.
                after = False
                for j in range(i + 1, min(len(classes), i + 4)):
                    if classes[j] in ("insult", "threat") and not any(classes[k] == "negation" for k in range(max(0, j - 3), j)):
                        break
                    if classes[j] == "target":
                        after = True
                        break
                name = f"aimed {c}" if before or (after and not any(i < k for k in said)) else c
            found.append((i, name))
        if found:
            last = max(said, default=-1)
            best = max((toxgrammar.PRIOR[n], toxgrammar.PATTERNS.index(n)) for i, n in found if i > last) if any(i > last for i, _ in found) else None
            if any(i < last for i, _ in found):
                retold = (toxgrammar.PRIOR["reported"], toxgrammar.PATTERNS.index("reported"))
                best = retold if best is None else max(best, retold)
            counts[best[1]] += 1
    return counts


def test_grammar_equals_a_slow_model():
    model = toxgrammar.Model(frozenset({"idio"}))
    rng = random.Random(6)
    words = ["idiot", "kill", "killed", "you", "them", "not", "don't", "said", "a", "house", "of", ".", ";", "\n"]
    for _ in range(4000):
        text = " ".join(rng.choices(words, k=rng.randrange(0, 14)))
        assert model.clauses(text) == slow_clauses(model, text), text


def test_held_out_toxicity(spark):
    labels = table(spark, MEDIUM, "labels").select("doc_id", "toxic")
    found = toxgrammar.toxicity(table(spark, MEDIUM, "documents"), labels, toxgrammar.learnable())
    rows = found.join(labels, "doc_id").where(~toxgrammar.learnable()("doc_id")).collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert right >= 0.95 * len(rows)
    assert not any(r["predicted"] for r in rows if r["toxic"] == 0)


# --- pipeline


def test_stages_take_effect(spark):
    docs = table(spark, MEDIUM, "documents")
    items = [(r["item_id"], r["text"]) for r in table(spark, MEDIUM, "benchmark").collect()]
    now = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = now
        now = staged(stage(spark, before, MEDIUM), "stage")
        assert now.columns == docs.columns
        gone = before.join(now.select("doc_id"), "doc_id", "left_anti")
        if name == "near copies":
            rows = before.orderBy("doc_id").collect()
            roots = brute_components([r["text"] for r in rows])
            assert {r["doc_id"] for r in gone.collect()} == {rows[i]["doc_id"] for i, c in enumerate(roots) if c != i}
        if name == "decontamination":
            for r in gone.limit(5).collect():
                n, hit, _, _ = decontam.brute_force(r["text"], items)
                assert hit > 0 and 20 * hit >= n
