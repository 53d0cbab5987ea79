"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, chat, html, licenses, packing, phrases, quality, repeats, rpforest, simhash, toxicity, urls
from .common import table


def op1_rpforest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rpforest.embedding_components(table(spark, sf_dir, "embeddings"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), passage=repeats.PASSAGE)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with the licenses that its text names or carries."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.license_summary(docs)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.preference_pairs(table(spark, sf_dir, "conversations"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(table(spark, sf_dir, "pages"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, judged by the rules and by the list of addresses whose documents are labelled toxic."""
    pages = table(spark, sf_dir, "pages")
    return urls.filter_urls(pages, urls.toxic_pages(pages, table(spark, sf_dir, "labels")))


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_rpforest, op2_simhash, op3_toxicity, op4_suffix_array, op5_packing, op6_licenses, op7_bpe, op8_chat, op9_html, op10_quality, op11_phrases, op12_urls, op13_audit)}


def oracle_sql() -> dict[str, str]:
    return {"op1_rpforest": rpforest.SQL, "op4_suffix_array": repeats.SQL, "op6_licenses": licenses.SQL, "op8_chat": chat.SQL, "op9_html": html.SQL, "op10_quality": quality.SQL, "op11_phrases": phrases.SQL, "op12_urls": urls.SQL, "op13_audit": audit.SQL}
