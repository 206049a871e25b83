"""Registered queries of the training-data operators: thin wrappers with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storepulse.llm import (
    collocations, conversations, decontamination, html_text, langid, licenses, mixing, ngram_join, pii, quality,
    quality_rules, sharding, topk,
)
from storepulse.llm.common import table


def op1_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs).drop("text")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return licenses.scan(licenses.document_files(docs)).drop("source")


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages)


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op6_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.shard_rows(docs, ["doc_id"])


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op8_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "part", "taken")


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        decontamination.items_digest().alias("items_sha256"), "contaminated",
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.ngram_join(docs).select("doc_id", "n_shingles", "component_id")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repair(rows, F.col("present"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = quality_rules.apply_policy(quality_rules.ledger(docs))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *base, quality_rules.base_failed().alias("base_failed"), "kept", "fails", "policy")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_weak_label_quality,
        op2_license_scan,
        op3_pii_surrogates,
        op4_main_text,
        op5_exact_top_k,
        op6_external_shuffle,
        op7_language_id,
        op8_water_filling,
        op9_benchmark_leaks,
        op10_ngram_join,
        op11_collocations,
        op12_conversation_repair,
        op13_quality_rules,
        pipeline,
    )
}
