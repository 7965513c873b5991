import re

import pytest
from pyspark.sql import functions as F

from modeforge import MISSING_MARKER, MixtureConfig, TableEncoder, TableSpec
from modeforge.sources.scratch import scratch_path

FEW = MixtureConfig(max_iter=4, n_components=4)


def mixed_table(spark):
    rows = [
        (i, float(i % 37) * 3.1, 0.0 if i % 3 == 0 else (MISSING_MARKER if i % 7 == 0 else i * 0.5),
         ["a", "b", None][i % 3], i % 4)
        for i in range(300)
    ]
    return spark.createDataFrame(rows, "id bigint, x double, m double, c string, k int")


def spec(**changes):
    options = dict(
        categorical=["c", "k"], mixed={"m": [0.0, MISSING_MARKER]}, columns=["x", "m", "c", "k"]
    )
    return TableSpec(**{**options, **changes})


def same(a, b, tolerance=1e-9):
    if a is None or b is None or isinstance(a, str):
        return a == b
    return abs(a - b) <= tolerance * max(1.0, abs(b))


def test_lossless_round_trip_of_all_kinds(spark):
    df = mixed_table(spark)
    encoder = TableEncoder(spec(), FEW).fit(df)
    coded = encoder.transform(df, "id", keep=["id"], lossless=True)
    assert [c for c in coded.columns if c.startswith("col_")] == [
        f"col_{i}" for i in range(encoder.output_dimensions)
    ]
    back = {r["id"]: r for r in encoder.inverse_transform(coded, keep=["id"]).collect()}
    for r in df.collect():
        assert all(same(back[r["id"]][c], r[c]) for c in "xmck"), (r, back[r["id"]])
    assert dict(encoder.inverse_transform(coded).dtypes)["k"] == "int"


def test_columns_by_position(spark):
    df = mixed_table(spark).drop("id")
    by_name = TableEncoder(spec(), FEW).fit(df)
    by_place = TableEncoder(
        TableSpec(categorical=[2, 3], mixed={1: [0.0, MISSING_MARKER]}), FEW
    ).fit(df)
    assert by_place.output_info == by_name.output_info


def test_layout_and_metadata(spark):
    df = mixed_table(spark)
    encoder = TableEncoder(spec(), FEW).fit(df)
    layout = encoder.layout(spark).collect()
    assert sum(r["width"] for r in layout) == encoder.output_dimensions
    assert [r["activation"] for r in layout] == ["tanh", "softmax"] * 2 + ["softmax"] * 2
    kinds = {r["column"]: r for r in encoder.metadata(spark).collect()}
    assert kinds["x"]["max"] == pytest.approx(36 * 3.1)
    assert kinds["m"]["modal_values"] == [0.0, MISSING_MARKER]
    assert kinds["c"]["categories"] == ["a", "b"]


def test_one_hot_sums(spark):
    df = mixed_table(spark)
    encoder = TableEncoder(spec(), FEW).fit(df)
    coded = encoder.transform(df, "id", keep=["c"])
    start = 0
    for (width, activation), at in zip(encoder.output_info, range(9)):
        cols = " + ".join(f"col_{start + j}" for j in range(width))
        start += width
        if activation == "softmax":
            sums = {r["s"] for r in coded.where("c IS NOT NULL").selectExpr(f"{cols} AS s").collect()}
            assert sums == {1.0}, at


def test_marker_is_zero_in_any_place(spark):
    df = mixed_table(spark)
    got = []
    for points in ([0.0, MISSING_MARKER], [MISSING_MARKER, 0.0]):
        encoder = TableEncoder(spec(mixed={"m": points}, columns=["m"], categorical=[]), FEW).fit(df)
        coded = encoder.transform(df, "id", keep=["id", "m"])
        assert {r["col_0"] for r in coded.where(f"m = {MISSING_MARKER}").collect()} == {0.0}
        got.append({r["id"]: r["col_0"] for r in coded.collect()})
    assert got[0] == got[1]


def test_only_modal_values(spark):
    df = spark.createDataFrame([(i, [0.0, MISSING_MARKER][i % 2]) for i in range(20)], "id int, m double")
    encoder = TableEncoder(
        TableSpec(mixed={"m": [0.0, MISSING_MARKER]}, columns=["m"]), FEW
    ).fit(df)
    assert encoder.output_info == [(1, "tanh"), (2, "softmax")]
    back = encoder.inverse_transform(encoder.transform(df, "id", keep=["id"]), keep=["id"])
    assert back.exceptAll(df).isEmpty()


def test_unseen_category(spark):
    fit_on = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    new = spark.createDataFrame([("c",), ("a",), (None,)], "c string")
    lenient = TableEncoder(TableSpec(categorical=["c"])).fit(fit_on)
    got = [tuple(r) for r in lenient.transform(new).collect()]
    assert got == [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]
    assert [r["c"] for r in lenient.inverse_transform(lenient.transform(new)).collect()] == [
        None, "a", None,
    ]
    strict = TableEncoder(TableSpec(categorical=["c"], unseen="error")).fit(fit_on)
    with pytest.raises(Exception, match="unseen category in c: c"):
        strict.transform(new).collect()


def test_too_many_categories_for_one_hot(spark):
    df = spark.range(500).selectExpr("id", "CAST(id % 50 + 1000 AS INT) AS c")
    df = df.unionAll(df.where("c = 1049"))
    encoder = TableEncoder(TableSpec(categorical=["c"], columns=["c"], indexed=["c"])).fit(df)
    assert encoder.output_info == [(1, "index")]
    coded = encoder.transform(df, keep=["id", "c"])
    assert {r["col_0"] for r in coded.where("c = 1049").collect()} == {0.0}
    assert coded.selectExpr("min(col_0)", "max(col_0)", "count(DISTINCT col_0)").first() == (0, 49, 50)
    back = encoder.inverse_transform(coded.drop("c"), keep=["id"])
    assert back.exceptAll(df.select("id", "c")).isEmpty()
    assert dict(back.dtypes)["c"] == "int"


def test_rare_categories_are_joined_by_shuffle(spark, monkeypatch):
    from modeforge.operators import lookup

    monkeypatch.setattr(lookup, "HOT", 7)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    df = spark.range(400).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 11 = 1 THEN NULL "
        "WHEN id % 50 = 2 THEN 'part -1' ELSE CAST(id % 60 AS STRING) END AS c"
    )
    encoder = TableEncoder(TableSpec(categorical=["c"], columns=["c"], indexed=["c"])).fit(df)
    coded = encoder.transform(df, keep=["id", "c"])
    assert coded.count() == 400
    assert {r["col_0"] for r in coded.where("c = 'hot'").collect()} == {0.0}
    assert {r["col_0"] for r in coded.where("c IS NULL").collect()} == {None}
    assert coded.selectExpr("count(DISTINCT c)", "count(DISTINCT col_0)").first()[0] == (
        coded.selectExpr("count(DISTINCT col_0)").first()[0]
    )
    back = encoder.inverse_transform(coded.drop("c"), keep=["id"])
    assert back.exceptAll(df).isEmpty() and back.count() == 400


def test_resolved_rows_of_a_large_dictionary_are_not_exchanged(spark, monkeypatch):
    from modeforge.operators import lookup

    monkeypatch.setattr(lookup, "HOT", 3)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    df = spark.range(300).selectExpr("id", "CASE WHEN id < 200 THEN 'a' ELSE CAST(id % 40 AS STRING) END AS c")
    encoder = TableEncoder(TableSpec(categorical=["c"], columns=["c"], indexed=["c"])).fit(df)
    new = df.unionAll(spark.range(50).selectExpr("id + 1000", "'never seen'"))
    coded = encoder.transform(new, keep=["id", "c"])
    assert coded.count() == 350
    assert coded.where("c = 'never seen'").agg(F.count("col_0")).first()[0] == 0
    assert coded.where("c <> 'never seen' AND col_0 IS NULL").isEmpty()
    # Of the two branches, only that of the rows still open has a shuffle join.
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = encoder.transform(new, keep=["id", "c"])
        plan = again._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 1


@pytest.mark.parametrize("indexed", [True, False])
@pytest.mark.parametrize("categories", ["ranked", "codes"])
def test_unseen_is_an_error_on_every_form(spark, indexed, categories):
    fit_on = spark.createDataFrame([(1,), (3,), (1,)], "c int")
    spec = TableSpec(
        categorical=["c"], categories=categories, unseen="error", indexed=["c"] if indexed else []
    )
    encoder = TableEncoder(spec).fit(fit_on)
    assert encoder.transform(spark.createDataFrame([(3,), (None,)], "c int")).count() == 2
    with pytest.raises(Exception, match="unseen category in c: 9"):
        encoder.transform(spark.createDataFrame([(9,)], "c int")).collect()


def test_codes_need_not_be_dense(spark):
    df = spark.createDataFrame([(1,), (2,), (5,)], "c int")
    encoder = TableEncoder(TableSpec(categorical=["c"], categories="codes")).fit(df)
    assert encoder.output_dimensions == 6
    assert encoder.inverse_transform(encoder.transform(df)).exceptAll(df).isEmpty()
    with pytest.raises(ValueError, match="negative"):
        TableEncoder(TableSpec(categorical=["c"], categories="codes")).fit(df.selectExpr("-c AS c"))


def test_lossless_keeps_exact_types_and_values_out_of_range(spark):
    big = 9007199254740993
    fit_on = spark.createDataFrame([(0, 1.0, 1), (1, 2.0, 5)], "id int, x double, k bigint")
    new = spark.createDataFrame(
        [(0, 99.0, big), (1, float("nan"), 3), (2, None, None), (3, 1.25, -(1 << 60))],
        "id int, x double, k bigint",
    )
    for continuous in ("minmax", "mixture"):
        spec = TableSpec(columns=["x", "k"], continuous=continuous)
        encoder = TableEncoder(spec, MixtureConfig(max_iter=3, n_components=2)).fit(fit_on)
        coded = encoder.transform(new, "id", keep=["id"], lossless=True)
        back = encoder.inverse_transform(coded, keep=["id"])
        assert dict(back.dtypes)["k"] == "bigint"
        rows = {r["id"]: (r["x"], r["k"]) for r in back.collect()}
        assert rows[0] == (99.0, big) and rows[1][1] == 3 and rows[1][0] != rows[1][0]
        assert rows[2] == (None, None) and rows[3][1] == -(1 << 60)
        assert rows[3][0] == pytest.approx(1.25)


def test_save_and_load(spark):
    df = spark.range(400).selectExpr(
        "id", "CAST(id % 7 AS STRING) AS kind", "CAST(id % 90 AS STRING) AS code",
        "CASE WHEN id % 5 = 0 THEN 0.0D ELSE sqrt(id) END AS fee", "CAST(id AS DOUBLE) AS x",
    )
    spec = TableSpec(
        categorical=["kind", "code"], indexed=["code"], mixed={"fee": [0.0]},
        columns=["kind", "code", "fee", "x"],
    )
    encoder = TableEncoder(spec, MixtureConfig(max_iter=4, n_components=3, normalization_factor=2.0)).fit(df)
    path = scratch_path(spark, "encoder")
    encoder.save(spark, path)
    loaded = TableEncoder.load(spark, path)
    assert loaded.spec == encoder.spec and loaded.config == encoder.config
    assert loaded.output_info == encoder.output_info
    one, two = (e.transform(df, "id", keep=["id"], lossless=True) for e in (encoder, loaded))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert loaded.inverse_transform(two, keep=["id"]).exceptAll(encoder.inverse_transform(one, keep=["id"])).isEmpty()


def test_min_max_variant(spark):
    df = spark.createDataFrame(
        [(0, 0.0, 5.0, 0), (1, 10.0, 5.0, 1), (2, 5.0, 5.0, None), (3, 2.5, 5.0, 2)],
        "id int, x double, flat double, k int",
    )
    encoder = TableEncoder(
        TableSpec(
            categorical=["k"], mixed={"x": [5.0]}, columns=["x", "flat", "k"],
            continuous="minmax", categories="codes",
        )
    ).fit(df)
    assert encoder.output_info == [(1, "tanh"), (1, "softmax"), (1, "tanh"), (4, "softmax")]
    got = {r["id"]: tuple(r)[1:] for r in encoder.transform(df, keep=["id"]).collect()}
    assert got[0] == (-1.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0)
    assert got[1] == (1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0)
    assert got[2] == (0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0)
    back = encoder.inverse_transform(encoder.transform(df, keep=["id"]), keep=["id"])
    assert back.exceptAll(df).isEmpty()


def test_bad_specs(spark):
    df = mixed_table(spark)
    with pytest.raises(ValueError, match="not numeric"):
        TableEncoder(TableSpec()).fit(df)
    with pytest.raises(ValueError, match="no such column"):
        TableEncoder(TableSpec(categorical=["nope"])).fit(df)
    with pytest.raises(ValueError, match="fit the encoder"):
        TableEncoder().transform(df)


def test_lossless_tables_are_exact_to_the_last_bit(spark):
    rows = [(i, 0.01 + i * 1e-5 if i % 2 else 1e13 * (i + 0.1), [0.0, -0.0, 0.1, 9007199254740993.0][i % 4], 9007199254740992 + i) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, x double, m double, k bigint")
    for continuous in ("mixture", "minmax"):
        spec = TableSpec(columns=["x", "m", "k"], mixed={"m": [0.0, 0.1], "k": [9007199254740992.0]}, continuous=continuous)
        encoder = TableEncoder(spec, FEW).fit(df)
        coded = encoder.transform(df, "id", keep=["id"], lossless=True)
        for r in encoder.inverse_transform(coded, keep=["id"]).collect():
            assert repr(tuple(r)) == repr(rows[r["id"]])


def test_sparse_vectors(spark):
    rows = [(i, f"name {i % 3000:04d}", i % 5) for i in range(4000)] + [(4000, None, 1)]
    df = spark.createDataFrame(rows, "id bigint, name string, k int")
    encoder = TableEncoder(TableSpec(categorical=["name", "k"], columns=["name", "k"], sparse=["name"])).fit(df)
    assert encoder.output_info == [(3000, "softmax"), (5, "softmax")] and encoder.output_dimensions == 5
    layout = [tuple(r) for r in encoder.layout(spark).collect()]
    assert layout == [("name", None, 3000, "softmax"), ("k", 0, 5, "softmax")]
    coded = encoder.transform(df, keep=["id"])
    got = {r["id"]: r["sparse_name"] for r in coded.collect()}
    # The first thousand names come twice, so they are ranked first.
    assert got[7]["indices"] == [7] and got[7]["values"] == [1.0] and got[7]["size"] == 3000
    assert got[3007]["indices"] == [7] and got[2999]["indices"] == [2999] and got[4000]["indices"] == []
    back = encoder.inverse_transform(coded, keep=["id"])
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "name 00" not in plan and len(plan) < 50_000
    path = scratch_path(spark, "sparse")
    encoder.save(spark, path)
    assert TableEncoder.load(spark, path).inverse_transform(coded, keep=["id"]).exceptAll(df).isEmpty()


def test_sparse_vectors_of_others_and_unseen_values(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    encoder = TableEncoder(TableSpec(categorical=["c"], sparse=["c"])).fit(df)
    new = spark.createDataFrame([("zzz",), ("b",)], "c string")
    assert [r["sparse_c"]["indices"] for r in encoder.transform(new).collect()] == [[], [1]]
    # The first of the largest values decides, wherever it stands; none does without a value above 0.
    made = spark.createDataFrame(
        [((2, [1, 0], [0.7, 0.7]),), ((2, [0, 1], [0.2, 0.9]),), ((2, [0], [0.0]),), ((2, [], []),)],
        "sparse_c struct<size: bigint, indices: array<bigint>, values: array<double>>",
    )
    assert [r["c"] for r in encoder.inverse_transform(made).collect()] == ["b", "b", None, None]
    with pytest.raises(ValueError, match="both indexed and sparse"):
        TableEncoder(TableSpec(categorical=["c"], sparse=["c"], indexed=["c"])).fit(df)
    with pytest.raises(ValueError, match="only categorical"):
        TableEncoder(TableSpec(sparse=["c"])).fit(df)


@pytest.mark.parametrize("categories", ["ranked", "codes"])
def test_blocks_beyond_the_width_are_an_error(spark, categories):
    df = spark.range(50).selectExpr("CAST(id * 100000000 AS BIGINT) AS c")
    options = dict(categorical=["c"], categories=categories)
    with pytest.raises(ValueError, match="column c has .* list it in indexed or sparse"):
        TableEncoder(TableSpec(one_hot_width=49, **options)).fit(df)
    coded = TableEncoder(TableSpec(sparse=["c"], **options)).fit(df)
    assert coded.inverse_transform(coded.transform(df)).exceptAll(df).isEmpty()


def test_categories_of_wide_blocks_stay_in_tables(spark, monkeypatch):
    from modeforge.operators import table

    df = spark.range(300).selectExpr("id", "concat('value ', id % 90) AS c", "concat('w', id % 7) AS d")
    spec = TableSpec(categorical=["c", "d"], columns=["c", "d"], unseen="error")
    wide = TableEncoder(spec).fit(df)
    assert wide.codes[0].values == () and wide.codes[0].dictionary is not None and len(wide.codes[1].values) == 7
    coded = wide.transform(df, keep=["id"])
    assert "value 1" not in coded._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(table, "LITERALS", 1000)
    listed = TableEncoder(spec).fit(df)
    assert len(listed.codes[0].values) == 90
    assert coded.exceptAll(listed.transform(df, keep=["id"])).isEmpty()
    for encoder in (wide, listed):
        assert encoder.inverse_transform(coded, keep=["id"]).exceptAll(df).isEmpty()
    assert wide.metadata(spark).exceptAll(listed.metadata(spark)).isEmpty()
    with pytest.raises(Exception, match="unseen category in c"):
        wide.transform(df.withColumn("c", F.lit("other"))).collect()


def test_broadcasts_share_one_bound(spark, monkeypatch):
    from modeforge.operators import lookup

    sizes = [30, 10, 20, 500]
    made = [lookup.Dictionary(None, 0, n) for n in sizes]
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 60)
    assert lookup.within_budget(made) == [True, True, True, False]
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 35)
    assert lookup.within_budget(made) == [False, True, True, False]
    assert lookup.hot_entries(1).startswith("idx < 10000 ") and lookup.hot_entries(50).startswith("idx < 2000 ")


def test_hot_values_are_split_by_their_counts(spark, monkeypatch):
    """Unseen and rare values that many rows have, with nothing broadcast."""
    from modeforge.operators import lookup

    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "HOT", 1)
    monkeypatch.setattr(lookup, "ROWS_A_PART", 50)
    fit_on = spark.range(200).selectExpr("concat('c', id) AS c", "concat('d', id % 3) AS d")
    encoder = TableEncoder(TableSpec(categorical=["c", "d"], indexed=["c", "d"])).fit(fit_on)
    df = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'unseen' WHEN id % 3 = 1 THEN 'c77' ELSE concat('c', id % 200) END AS c",
        "CASE WHEN id % 10 > 0 THEN concat('d', id % 3) END AS d",
    )
    coded = encoder.transform(df, keep=["id"])
    assert coded.count() == 3000
    back = encoder.inverse_transform(coded, keep=["id"])
    expected = df.withColumn("c", F.expr("nullif(c, 'unseen')"))
    assert back.exceptAll(expected).isEmpty() and expected.exceptAll(back).isEmpty()


def large_dictionary(spark, monkeypatch, rows):
    """Rows to look up in a dictionary that is too large to broadcast, and their encoder."""
    from modeforge.operators import lookup

    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "HOT", 1)
    df = spark.range(rows).selectExpr("id", "concat(repeat('long ', 20), id) AS c")
    return df, TableEncoder(TableSpec(categorical=["c"], columns=["c"], indexed=["c"])).fit(df)


def test_large_dictionaries_are_never_broadcast(spark, monkeypatch):
    """Text that compresses well looks small to the planner."""
    df, encoder = large_dictionary(spark, monkeypatch, 100)
    coded = encoder.transform(df, keep=["id"])
    for shuffled, joins in ((coded, 1), (encoder.inverse_transform(coded, keep=["id"]), 2)):
        rows = shuffled.collect()
        assert len(rows) == 100 and all(r[1] is not None for r in rows)
        plan = shuffled._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert plan.count("ShuffledHashJoin") >= joins and "SortMergeJoin" not in plan
        assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "__other" in line]


@pytest.mark.parametrize("categories", ["ranked", "codes"])
def test_blocks_beyond_the_width_can_be_sparse(spark, categories):
    df = spark.range(300).selectExpr("id", "CAST(id % 50 AS BIGINT) AS c", "CAST(id % 49 AS BIGINT) AS d")
    options = dict(categorical=["c", "d"], columns=["c", "d"], categories=categories, one_hot_width=49)
    encoder = TableEncoder(TableSpec(wide="sparse", **options)).fit(df)
    assert [code.sparse for code in encoder.codes] == [True, False] and encoder.output_dimensions == 49
    path = scratch_path(spark, "wide")
    encoder.save(spark, path)
    coded = TableEncoder.load(spark, path).transform(df, keep=["id"])
    assert coded.selectExpr("min(sparse_c.size)", "max(size(sparse_c.indices))").first() == (50, 1)
    assert encoder.inverse_transform(coded, keep=["id"]).exceptAll(df).isEmpty()
    with pytest.raises(ValueError, match="wide must be"):
        TableSpec(wide="dense")


def test_wide_one_hot_query_at_more_suppliers_than_columns(spark, tmp_path):
    from modeforge.plans.catalog import QUERIES

    spark.range(2500).selectExpr(
        "id AS l_orderkey", "1 AS l_linenumber", "id AS l_partkey", "id % 2100 AS l_suppkey"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["category_one_hot_wide"](spark, str(tmp_path))
    # The first 400 suppliers have two lines each.
    assert found.selectExpr("count(*)", "min(width)", "count(DISTINCT place)", "min(ones)", "max(ones)").first() == (2500, 2100, 2100, 1.0, 1.0)
    assert found.where("l_suppkey < 400 AND place >= 400 OR l_suppkey >= 400 AND place < 400").isEmpty()


def test_parts_of_a_large_dictionary_follow_its_bytes(spark, monkeypatch):
    """A task holds a bounded piece of the dictionary and sorts no rows, however many there are."""
    from modeforge.operators import lookup

    monkeypatch.setattr(lookup, "PART_BYTES", 1 << 10)
    found = []
    for rows in (100, 200):
        df, encoder = large_dictionary(spark, monkeypatch, rows)
        plan = encoder.transform(df, keep=["id"])._jdf.queryExecution().sparkPlan().toString()
        assert "ShuffledHashJoin" in plan and "Sort" not in plan
        parts = {int(n) for n in re.findall(r"hashpartitioning\(__(?:key|match)[^)]*, (\d+)\)", plan)}
        found.append((encoder.codes[0].dictionary.bytes, parts))
    for size, parts in found:
        assert parts == {-(-size // (1 << 10))}
    assert max(found[1][1]) > 1.9 * max(found[0][1])
