"""Every query with SQL equals it; the pipeline and the odd tables run through."""

from __future__ import annotations

import importlib.util
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from modeforge.llm import queries
from modeforge.llm.oracle import oracle_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
_path = Path(__file__).parents[1] / "compare.py"
_spec = importlib.util.spec_from_file_location("compare_tool", _path)
compare = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(compare)


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_query_equals_sql(spark, name):
    mine = queries.QUERIES[name](spark, FOLDER).toPandas()
    theirs = compare.connect(FOLDER).execute(oracle_queries()[name]).df()
    assert compare.difference(mine, theirs) is None


ODD = [
    (1, None, None, None), (2, "", "en", "src1"), (3, " \t\n", "en", "src1"), (None, "a b c d e f", None, "src2"),
    (5, "a b c d e f", "en", None), (5, "a b c d e f", "en", None), (6, "word " * 30_000, "de", "src3"), (7, "é" * 5000, "fr", "x"),
    (8, "you idiot. 12 ?!", "en", "src4"), (9, "x", "en", "src99999999999999999999"),
]
LABELS = [(1, None, None), (2, 0, 0), (None, 1, 1), (8, 0, 1), (8, 0, 0)]
PAGES = [(1, None, None), (2, "", "x"), (3, "no scheme/a", "x"), (4, "http://A.example.net/en/x?b=1&a=2#f", "x"), (None, "http://a.example.net/en/x?a=2&b=1", "x"), (6, "ftp://net/", "x"), (7, "http://" + "a." * 3000 + "net/", "x")]
TALK = [(1, 0, "user", None), (1, None, "assistant", "no number here"), (None, 4, "tool", "of none"), (1, 1, "assistant", 'say "x"\n'), (1, 1, "assistant", "again"), (1, 2, None, "r"), (None, 1, "assistant", "x"), (2, None, "user", "x"), (2, 3, "assistant", "")]


def _write(spark, folder, empty):
    tables = {
        "documents": (ODD, "doc_id long, text string, lang string, source string"),
        "labels": (LABELS, "doc_id long, quality int, toxic int"),
        "benchmark": ([(1, None), (None, "a b c"), (3, "a b c"), (4, "")], "item_id long, text string"),
        "pages": (PAGES, "page_id long, url string, html string"),
        "conversations": (TALK, "conv_id long, turn long, role string, text string"),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame([] if empty else rows, schema)
        # Names that the operators use or give themselves.
        for extra in ("row", "keep_id", "n", "shard", "score", "_score", "level", "key", "h", "u", "cid", "_row", "n_words"):
            df = df.withColumn(extra, F.lit("clash"))
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return _write(spark, tmp_path_factory.mktemp("odd"), empty=False)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return _write(spark, tmp_path_factory.mktemp("empty"), empty=True)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_odd_and_empty_tables(spark, odd, empty, name):
    rows = queries.QUERIES[name](spark, odd).collect()
    size = {"op1_tool_calls": 8, "op5_url_bloom": len(PAGES), "op11_shared_search": 6, "op12_spelling_forms": 0, "op13_main_text": len(PAGES)}.get(name, len(ODD))
    assert len(rows) == size
    assert queries.QUERIES[name](spark, empty).count() == 0
    if name in oracle_queries():
        con = compare.duckdb.connect()
        for table in ("documents", "labels", "benchmark", "pages", "conversations"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{odd}/{table}.parquet/*.parquet'")
        theirs = con.execute(oracle_queries()[name]).df()
        assert compare.difference(queries.QUERIES[name](spark, odd).toPandas(), theirs) is None


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0
    assert corpus_pipeline.run(spark, odd).count() > 0
