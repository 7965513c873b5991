import math

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from plain_fit import digamma as other_digamma

from modeforge.functions.special import digamma, log_beta
from modeforge.functions.text import number, quoted, string
from modeforge.functions.uniform import keyed_uniform


def test_digamma_known_values():
    assert digamma(1.0) == pytest.approx(-0.5772156649015329, abs=1e-12)
    assert digamma(0.5) == pytest.approx(-1.9635100260214235, abs=1e-11)


@given(st.floats(min_value=1e-3, max_value=1e9))
def test_digamma_recurrence_and_other_form(x):
    assert digamma(x + 1) == pytest.approx(digamma(x) + 1 / x, rel=1e-9, abs=1e-9)
    assert digamma(x) == pytest.approx(other_digamma(x), rel=1e-9, abs=1e-9)


def test_log_beta():
    assert log_beta(2.0, 3.0) == pytest.approx(math.log(1 / 12))


@given(st.floats(allow_nan=False, allow_infinity=False))
def test_number_reads_back(x):
    text = number(x).strip("()")
    assert text.endswith("D") and float(text[:-1]) == x


def test_names_and_strings_are_escaped(spark):
    df = spark.createDataFrame([(1,)], ["a`b"])
    assert df.selectExpr(f"{quoted('a`b')} AS x").first()["x"] == 1
    text = "it's a \\ line"
    assert spark.range(1).selectExpr(f"{string(text)} AS x").first()["x"] == text


@pytest.mark.parametrize("portable", [True, False])
def test_uniform_looks_uniform_and_stays_with_the_row(spark, portable):
    u = keyed_uniform(["id"], 1, "test", portable)
    df = spark.range(20000)
    a = df.selectExpr("id", f"{u} AS u").toPandas().sort_values("id")["u"].to_numpy()
    b = df.repartition(7).selectExpr("id", f"{u} AS u").toPandas().sort_values("id")["u"]
    assert (a == b.to_numpy()).all()
    assert a.min() > 0 and a.max() < 1
    counts = np.histogram(a, bins=20, range=(0, 1))[0]
    assert abs(counts - 1000).max() < 150
    other = keyed_uniform(["id"], 1, "other", portable)
    c = df.selectExpr("id", f"{other} AS u").toPandas().sort_values("id")["u"].to_numpy()
    assert abs(np.corrcoef(a, c)[0, 1]) < 0.05
