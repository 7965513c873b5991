"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modeforge.llm import decontam, exactdup, fragjoin, hashtree, langmix, lbl, lexsearch, maintext, mixing, spelling, toolcalls, toxgrammar, urlbloom
from modeforge.llm.common import id_crc, table


def op1_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    return toolcalls.link_calls(*toolcalls.calls_of(table(spark, folder, "conversations")))


def op2_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langmix.learn(docs.where(~langmix.held_out()))
    found = langmix.languages_of(docs, model)
    return found.select("doc_id", langmix.held_out().alias("held_out"), "lang_pred", "score")


def op3_log_bilinear(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lbl.score_documents(docs, ~lbl.held_out()).select(
        "doc_id", lbl.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_hash_tree(spark: SparkSession, folder: str) -> DataFrame:
    return hashtree.place(table(spark, folder, "documents"))


def op5_url_bloom(spark: SparkSession, folder: str) -> DataFrame:
    """The list to block is derived from the pages: canonical URLs that several pages have."""
    pages = table(spark, folder, "pages")
    return urlbloom.filter_urls(pages, urlbloom.repeated_urls(pages))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exactdup.exact_duplicates(table(spark, folder, "documents"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", decontam.items_digest().alias("items_sha256"), "contaminated")


def op8_fragment_join(spark: SparkSession, folder: str) -> DataFrame:
    return fragjoin.near_duplicates(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), mixing.PRODUCTION)


def op10_toxicity_grammar(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxgrammar.toxicity(docs, labels, toxgrammar.learnable()).select(
        "doc_id", (F.pmod(id_crc(), F.lit(3)) == 1).alias("held_out"), "score", "predicted"
    )


def op11_shared_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexsearch.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_spelling_forms(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op13_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return maintext.extract(table(spark, folder, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tool_calls": op1_tool_calls,
    "op2_language_mixture": op2_language_mixture,
    "op3_log_bilinear": op3_log_bilinear,
    "op4_hash_tree": op4_hash_tree,
    "op5_url_bloom": op5_url_bloom,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_fragment_join": op8_fragment_join,
    "op9_mixing": op9_mixing,
    "op10_toxicity_grammar": op10_toxicity_grammar,
    "op11_shared_search": op11_shared_search,
    "op12_spelling_forms": op12_spelling_forms,
    "op13_main_text": op13_main_text,
}
