import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from modeforge.operators import ks
from modeforge.operators.ks import ks_columns, ks_exact_p_value, ks_p_value, ks_two_sample
from modeforge.operators.validate import (
    bounds_check,
    error_by_decile,
    moments_check,
    round_trip,
    validate_columns,
)


def column(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


def brute(a, b):
    points = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    return abs(fa - fb).max()


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10_000))
def test_ks_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    a = np.round(rng.normal(0, 1, rng.integers(1, 400)), rng.integers(0, 4))
    b = np.round(rng.normal(0.2, 1.5, rng.integers(1, 400)), rng.integers(0, 4))
    got = ks_two_sample(column(spark, a), column(spark, b))
    assert got.statistic == pytest.approx(brute(a, b), abs=1e-12)
    assert (got.n, got.m) == (len(a), len(b))


def test_ks_with_a_hot_value(spark):
    a = np.concatenate([np.full(500, 3.0), np.arange(500.0)])
    b = np.concatenate([np.full(300, 3.0), np.arange(700.0)])
    got = ks_two_sample(column(spark, a).repartition(6), column(spark, b))
    assert got.statistic == pytest.approx(brute(a, b), abs=1e-12)


def test_ks_extremes(spark):
    a = column(spark, range(50))
    assert ks_two_sample(a, a).statistic == 0 and ks_two_sample(a, a).p_value == 1
    far = ks_two_sample(a, column(spark, range(100, 150)))
    assert far.statistic == 1 and far.p_value < 1e-9
    with pytest.raises(ValueError):
        ks_two_sample(a, column(spark, [None]))


def test_ks_columns_read_once(spark):
    df = spark.createDataFrame([(float(i), float(i * i % 17)) for i in range(60)], "a double, b double")
    pair = ks_two_sample(df.select("a"), df.select("b"))
    assert ks_columns(df, "a", "b").statistic == pair.statistic


def test_p_value_of_known_points():
    # Critical value of the limiting distribution at 5 %.
    assert ks_p_value(1.3581 / math.sqrt(500), 1000, 1000) == pytest.approx(0.05, abs=1e-3)
    assert ks_p_value(0.0, 10, 10) == 1.0


def test_bounds(spark):
    assert bounds_check(column(spark, [1, 2, 3]), "x", 1, 3).first() == (True, 0)
    got = bounds_check(column(spark, [0, 2, None, float("nan")]), "x", 1, 3).first()
    assert got == (False, 3)


def test_moments(spark):
    rng = np.random.default_rng(0)
    x = rng.lognormal(0, 1, 500)
    check = moments_check(column(spark, x), column(spark, x + 0.01))
    assert check.valid and check.differences["mean"] == pytest.approx(0.01)
    wide = moments_check(column(spark, x * 1000), column(spark, x * 1001))
    assert not wide.valid
    assert moments_check(column(spark, x * 1000), column(spark, x * 1001), relative=True).valid


def test_round_trip_counts(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (2.0, 2.5), (3.0, None), (4.0, 9.0), (None, None)], "x double, y double"
    )
    trip = round_trip(df, "x", "y")
    assert (trip.rows, trip.outside, trip.damaged, trip.max_error) == (5, 2, 3, 5.0)
    ok = validate_columns(df.selectExpr("x", "x AS y"), "x", "y")
    assert ok.accuracy == 1.0 and ok.round_trip.damaged == 0


def test_error_by_decile(spark):
    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS x", "id + IF(id >= 900, 1D, 0D) AS y")
    got = {r["decile"]: (r["rows"], r["max_error"]) for r in error_by_decile(df, "x", "y").collect()}
    assert len(got) == 10 and got[10][1] == 1.0 and got[1] == (100, 0.0)


def test_exact_quantiles(spark):
    import numpy as np

    from modeforge.operators.quantiles import exact_quantiles

    rng = np.random.default_rng(9)
    x = rng.integers(0, 400, 5000).astype(float)
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    shares = [i / 10 for i in range(1, 10)]
    expected = np.sort(x)[[int(np.ceil(s * len(x) - 1e-9)) - 1 for s in shares]]
    assert exact_quantiles(df, "x", shares) == expected.tolist()
    assert exact_quantiles(df.limit(0), "x", shares) == []


def path_share(statistic, n, m):
    """All orders of n and m values, one by one."""
    from itertools import combinations

    hit = total = 0
    for places in combinations(range(n + m), n):
        i = worst = 0
        for s in range(1, n + m + 1):
            i += s - 1 in places
            worst = max(worst, abs(i * m - (s - i) * n))
        hit += worst >= round(statistic * n * m)
        total += 1
    return hit / total


@pytest.mark.parametrize(("n", "m"), [(1, 1), (3, 5), (4, 4), (6, 4), (7, 5)])
def test_exact_p_values_count_paths(n, m):
    for h in range(n * m + 1):
        assert ks_exact_p_value(h / (n * m), n, m) == pytest.approx(path_share(h / (n * m), n, m), abs=1e-13)


def test_exact_p_values_of_large_samples():
    # Known limits: certain for no difference, 2 / C(n + m, n) for separate samples, the series in between.
    assert ks_exact_p_value(0.0, 700, 900) == 1.0
    assert ks_exact_p_value(1.0, 20, 30) == pytest.approx(2 / math.comb(50, 20), rel=1e-9)
    assert ks_exact_p_value(0.03, 9000, 10_000) == pytest.approx(ks_p_value(0.03, 9000, 10_000), rel=0.05)


def test_exact_test_and_its_bound(spark, monkeypatch):
    a, b = column(spark, [1, 2, 3, 4, None]), column(spark, [2.5, 5, 6, float("nan")])
    got = ks_two_sample(a, b, method="exact")
    assert got.p_value == pytest.approx(path_share(got.statistic, 4, 3))
    assert ks_two_sample(a, b, method="auto") == got != ks_two_sample(a, b)
    monkeypatch.setattr(ks, "EXACT_ROWS", 3)
    assert ks_two_sample(a, b, method="auto") == ks_two_sample(a, b)
    with pytest.raises(ValueError, match="at most 3"):
        ks_two_sample(a, b, method="exact")
    with pytest.raises(ValueError, match="method"):
        ks_two_sample(a, b, method="best")


def test_inexact_rows_are_counted_whatever_the_tolerance(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.1 + 0.2, 0.3), (1e6, 1e6 + 1e-9), (None, None), (float("nan"), float("nan")), (5.0, None)], "x double, y double")
    trip = round_trip(df, "x", "y")
    assert (trip.inexact, trip.damaged) == (3, 1)
    whole = spark.createDataFrame([(9007199254740993, 9007199254740992), (1, 1), (2, 2)], "x bigint, y bigint")
    assert round_trip(whole, "x", "y").inexact == 1
