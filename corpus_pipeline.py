"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from modeforge.llm import decontam, fragjoin, hashtree, mixing, toxgrammar
from modeforge.llm.common import staged, table

#: Nine tenths of the tokens that are left, with a moderate pull to the weights and no repeats.
MIXTURE = mixing.Mixture(
    weights={
        "domain": {"domain0": 300, "domain1": 250, "domain2": 250, "domain3": 200},
        "lang": {"en": 500, "de": 200, "fr": 200, "es": 100},
    },
    share=0.9,
    max_epochs=1,
)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar rejects go."""
    model = toxgrammar.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), toxgrammar.learnable())
    return toxgrammar.harmless_documents(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return fragjoin.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the budget of their domain, language and source stay."""
    return mixing.mixed_documents(docs, MIXTURE)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left gets its place in the hash tree."""
    return hashtree.place(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The toxicity grammar is learnt, which SQL can't express; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
