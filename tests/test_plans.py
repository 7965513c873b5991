"""The physical plans stay what they were designed to be."""

import contextlib
import io
import re

import pytest

from modeforge import MixtureConfig, ModeEncoder, TableEncoder, TableSpec, fit_mixture, inflate
from modeforge.operators.compress import compress, profile_numeric


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def encoder(events):
    return ModeEncoder("value", fit_mixture(events, "value", MixtureConfig(max_iter=3)))


def test_encode_and_decode_are_narrow_and_jvm_only(spark, small, encoder):
    df = spark.read.parquet(f"{small}/events.parquet")
    coded = encoder.encode(df, "event_id", drop_input=True)
    text = plan(encoder.decode(coded))
    assert "Exchange" not in text and "Python" not in text and "Join" not in text
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text


def test_filters_reach_the_scan_and_do_not_multiply(spark, small, encoder):
    df = spark.read.parquet(f"{small}/events.parquet")
    coded = encoder.encode(df, "event_id", with_mode=True)
    text = plan(coded.where("event_id > 10 AND mode = 1 AND normalized_value > 0"))
    assert "GreaterThan(event_id,10)" in text
    assert len(text) < 60_000


def test_encoding_compiles_to_a_small_method(spark, small, encoder):
    df = spark.read.parquet(f"{small}/events.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(encoder.encode(df, "event_id", lossless=True), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(v) for v in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_compression_is_one_partial_aggregation(spark, small):
    df = spark.read.parquet(f"{small}/lineitem.parquet")
    columns = {"a": "l_extendedprice", "b": "l_discount"}
    profiles, _ = profile_numeric(df, columns)
    text = plan(compress(df, columns, profiles), "simple")
    assert text.count("Exchange") == 1 and "partial_" in text
    assert "l_quantity" not in text


def test_inflating_needs_no_join(spark, events):
    assert "Join" not in plan(inflate(events, "value", 10_000, key="event_id"), "simple")


def test_table_encoding_is_narrow(spark, small):
    df = spark.read.parquet(f"{small}/lineitem.parquet")
    spec = TableSpec(
        categorical=["l_returnflag"], mixed={"l_discount": [0.0]},
        columns=["l_extendedprice", "l_discount", "l_returnflag"],
    )
    table = TableEncoder(spec, MixtureConfig(max_iter=2)).fit(df)
    text = plan(table.transform(df, ["l_orderkey", "l_linenumber"]))
    assert "Exchange" not in text and "Python" not in text
    assert "l_comment" not in text and "l_shipdate" not in text


def test_test_modules_have_names_of_their_own():
    """Two modules of one name would keep pytest from collecting the second."""
    from pathlib import Path

    names = [p.name for p in Path(__file__).parent.rglob("test_*.py")]
    assert len(names) == len(set(names))
