import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from modeforge import MixtureConfig, ModeEncoder, ModeNormalizer, fit_mixture
from modeforge.operators.model import Mixture
from modeforge.sources.scratch import scratch_path

TWO = Mixture(
    means=(0.0, 10.0), variances=(1.0, 4.0), beta=(51.0, 51.0), nu=(51.0, 51.0),
    a=(51.0, 51.0), b=(50.001, 0.001), active=(True, True), frequency=(40.0, 60.0),
)


def rows(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id bigint, x double")


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_hand_values(spark):
    df = rows(spark, [0.0, 1.0, 10.0, 100.0])
    got = by_id(ModeEncoder("x", TWO).encode(df, "id"))
    assert got[0]["normalized_value"] == 0.0 and got[0]["mode_encoding"] == [1.0, 0.0]
    assert got[1]["normalized_value"] == pytest.approx(0.25)
    assert got[2]["normalized_value"] == 0.0 and got[2]["mode_encoding"] == [0.0, 1.0]
    assert got[3]["normalized_value"] == 0.99


def test_clip_edges_and_lossless(spark):
    edge = [-3.96, -4.0, 10 + 7.92, 10 + 8.0, 1e9, -1e300]
    df = rows(spark, edge)
    encoder = ModeEncoder("x", TWO)
    plain = by_id(encoder.decode(encoder.encode(df, "id"), "y", keep_input=True))
    assert plain[0]["y"] == pytest.approx(-3.96) and plain[1]["y"] == pytest.approx(-3.96)
    assert plain[3]["y"] == pytest.approx(17.92)
    exact = by_id(encoder.decode(encoder.encode(df, "id", lossless=True), "y", keep_input=True))
    for i in (1, 3, 4, 5):
        assert exact[i]["y"] == edge[i]
    assert exact[0]["y"] == pytest.approx(edge[0])


def test_values_that_are_not_finite(spark):
    df = rows(spark, [None, float("nan"), float("inf"), 1.0])
    encoder = ModeEncoder("x", TWO)
    coded = encoder.encode(df, "id", lossless=True, with_mode=True)
    got = by_id(coded)
    for i in range(3):
        assert got[i]["normalized_value"] is None and got[i]["mode"] is None
        assert got[i]["mode_encoding"] == [0.0, 0.0]
    back = by_id(encoder.decode(coded, "y", keep_input=True))
    assert back[0]["y"] is None and math.isnan(back[1]["y"]) and back[2]["y"] == math.inf
    lossy = by_id(encoder.decode(encoder.encode(df, "id"), "y", keep_input=True))
    assert lossy[0]["y"] is None and lossy[1]["y"] is None


def test_inactive_component_is_never_drawn(spark):
    m = replace(TWO, active=(False, True))
    df = rows(spark, [0.0] * 50)
    got = ModeEncoder("x", m).encode(df, "id", with_mode=True)
    assert {(r["mode"], tuple(r["mode_encoding"])) for r in got.collect()} == {(0, (1.0,))}


@pytest.mark.parametrize("size", [17, 30])
def test_many_components(spark, size):
    """Cut into separately compiled parts, with sums in blocks."""
    m = Mixture(
        means=tuple(20.0 * i for i in range(size)), variances=(1.0,) * size,
        beta=(11.0,) * size, nu=(11.0,) * size, a=(11.0,) * size,
        b=tuple(10.0 * (size - 1 - i) + 0.001 for i in range(size)),
        active=(True,) * size, frequency=(1.0,) * size,
    )
    df = spark.range(size * 20).selectExpr("id", "CAST(id AS DOUBLE) AS x")
    got = by_id(ModeEncoder("x", m).encode(df, "id", with_mode=True, lossless=True))
    near = [got[20 * i]["mode"] == i and got[20 * i]["normalized_value"] == 0 for i in range(size)]
    # Smoothing may draw another mode about once in 10^4 rows.
    assert sum(near) >= size - 1
    encoder = ModeEncoder("x", m)
    back = encoder.decode(encoder.encode(df, "id", lossless=True), "y", keep_input=True)
    assert back.where("abs(x - y) < 1e-9").count() == size * 20


def test_draws_follow_the_probabilities(spark):
    # Half way between equally likely modes of equal width.
    m = replace(TWO, variances=(4.0, 4.0), a=(1001.0, 1001.0), b=(1001.0, 1e-3))
    df = spark.range(20000).withColumn("x", F.lit(5.0))
    first = ModeEncoder("x", m).encode(df, "id", with_mode=True).where("mode = 0").count()
    assert 9000 < first < 11000


def test_seed_and_partitions(spark, events):
    encoder = ModeEncoder("value", replace(TWO, variances=(900.0, 900.0)))
    modes = encoder.encode(events, "event_id", with_mode=True).select("event_id", "mode")
    again = encoder.encode(events.repartition(5), "event_id", with_mode=True)
    assert modes.exceptAll(again.select("event_id", "mode")).isEmpty()
    other = encoder.with_config(random_state=7).encode(events, "event_id", with_mode=True)
    assert not modes.exceptAll(other.select("event_id", "mode")).isEmpty()


def test_ranked_order_inverts(spark):
    df = rows(spark, [0.5, 11.0, -1.0, 9.0])
    encoder = ModeEncoder("x", TWO)
    coded = encoder.encode(df, "id", ranked=True, with_mode=True)
    assert TWO.order == (1, 0)
    got = by_id(encoder.decode(coded, "y", ranked=True, keep_input=True))
    for i, v in enumerate([0.5, 11.0, -1.0, 9.0]):
        assert got[i]["y"] == pytest.approx(v)
        assert got[i]["mode_encoding"][got[i]["mode"]] == 1.0


def test_soft_modes_decode_by_largest_and_clip(spark):
    df = spark.createDataFrame(
        [(0, 2.0, [0.2, 0.8]), (1, 0.5, [0.5, 0.5])],
        "id bigint, normalized_value double, mode_encoding array<double>",
    )
    encoder = ModeEncoder("x", TWO)
    got = by_id(encoder.decode(df, keep_input=True))
    assert got[0]["x"] == pytest.approx(10 + 8) and got[1]["x"] == pytest.approx(2.0)
    free = by_id(encoder.decode(df, keep_input=True, clip=False))
    assert free[0]["x"] == pytest.approx(10 + 16)


def test_other_columns(spark, events):
    encoder = ModeEncoder("value", TWO)
    kept = encoder.encode(events, "event_id")
    assert kept.columns == [*events.columns, "normalized_value", "mode_encoding"]
    bare = encoder.encode(events, "event_id", drop_input=True)
    assert bare.columns == ["normalized_value", "mode_encoding"]
    types = dict(bare.dtypes)
    assert types == {"normalized_value": "double", "mode_encoding": "array<double>"}


def test_without_key_still_encodes_every_row(events):
    assert ModeEncoder("value", TWO).encode(events).where("normalized_value IS NOT NULL").count() == (
        events.count()
    )


def test_save_and_load(spark):
    path = scratch_path(spark, "encoder")
    ModeEncoder("x", TWO).save(spark, path)
    back = ModeEncoder.load(spark, path)
    assert back.column == "x" and back.mixture.means == TWO.means


def test_state_guard_and_whole_cycle(spark, events):
    model = ModeNormalizer("value", MixtureConfig(max_iter=5))
    with pytest.raises(ValueError):
        model.transform(events)
    with pytest.raises(ValueError):
        model.inverse_transform(events)
    model.fit(events)
    coded = model.transform(events, "event_id", lossless=True)
    one = coded.selectExpr("aggregate(mode_encoding, 0D, (a, v) -> a + v) AS s").distinct()
    assert [r["s"] for r in one.collect()] == [1.0]
    back = model.inverse_transform(
        coded.withColumnRenamed("value", "raw"), keep_input=True
    ).selectExpr("max(abs(raw - value)) AS e")
    assert back.first()["e"] < 1e-9


def test_saved_settings_and_names(spark, events):
    cfg = MixtureConfig(max_iter=3, n_components=3, normalization_factor=2.0)
    encoder = ModeEncoder("value", fit_mixture(events, "value", cfg), cfg)
    path = scratch_path(spark, "mode-encoder")
    encoder.save(spark, path)
    assert ModeEncoder.load(spark, path).config == cfg
    both = encoder.encode(encoder.encode(events, "event_id"), "event_id", prefix="b_")
    assert both.where("normalized_value <> b_normalized_value").isEmpty()
    with pytest.raises(ValueError, match="choose a prefix"):
        encoder.encode(both, "event_id")
    big = spark.createDataFrame([(1, 9007199254740993), (2, 40)], "event_id long, value long")
    coded = encoder.encode(big, "event_id", lossless=True)
    back = {r["event_id"]: r["value"] for r in encoder.decode(coded, keep_input=True).collect()}
    assert back == {1: 9007199254740993, 2: 40}


def test_lossless_is_exact_to_the_last_bit(spark):
    small = [0.01001, 0.01003, 0.01005, 0.1 + 0.2, 5e-324, -5e-324, 1 / 3]
    wide = [1e15, 123456789012345.67, -1e15, 1e300, 0.0, -0.0, float("nan"), float("inf"), None]
    df = rows(spark, [*small, *wide, *(0.01 + i * 1e-5 for i in range(1000)), *(1e12 * (i + 0.1) for i in range(1000))])
    encoder = ModeEncoder("x", fit_mixture(df.where("abs(x) < 1e100"), "x", MixtureConfig(max_iter=5)))
    for options in ({}, {"ranked": True}):
        coded = encoder.encode(df, "id", lossless=True, **options)
        back = encoder.decode(coded, "y", keep_input=True, **options)
        for r in back.collect():
            assert repr(r["x"]) == repr(r["y"]), r


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("float", ["0.1", "3.4e38", "-0.0", "1e-45"]),
        ("bigint", ["9223372036854775807", "-9223372036854775808", "9007199254740993", "7"]),
        ("int", ["2147483647", "-2147483648", "0"]),
        ("decimal(38,4)", ["9999999999999999999999999999999999.9999", "0.0001", "-12.5000"]),
    ],
)
def test_lossless_for_all_types(spark, kind, values):
    df = spark.createDataFrame(list(enumerate([*values, "1", "2", "3", None])), "id bigint, t string").selectExpr("id", f"CAST(t AS {kind}) AS x")
    for encoder in (ModeEncoder("x", TWO), ModeEncoder("x", fit_mixture(df, "x", MixtureConfig(max_iter=3, n_components=2)))):
        back = encoder.decode(encoder.encode(df, "id", lossless=True), "y", keep_input=True)
        assert dict(back.dtypes)["y"] == kind
        assert back.where("NOT (x <=> y) OR CAST(x AS STRING) <> CAST(y AS STRING)").isEmpty()


def test_lossless_with_a_wide_clip_range(spark):
    encoder = ModeEncoder("x", TWO, MixtureConfig(clip_min=-3.0, clip_max=3.0))
    df = rows(spark, [0.3, 4.5, -7.77, 11.1, 25.0, 1e6])
    for clip in (True, False):
        back = encoder.decode(encoder.encode(df, "id", lossless=True), "y", keep_input=True, clip=clip)
        if clip:
            assert back.where("x <> y").isEmpty()
