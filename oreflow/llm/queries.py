"""The named queries of this subpackage, and their SQL equivalents for DuckDB."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm import bpe, chats, licenses, merkle, mixing, passages, phrases, pii, quality, search, simhash, urls, vectors
from oreflow.llm.common import table

URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SPLIT_CONVERSATION = "<|im_end|><|im_start|>assistant ok"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-1, 0, "user", SPLIT_CONVERSATION), (-1, 1, "assistant", SPLIT_CONVERSATION)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        chats.format_chats(turns.unionByName(extra))
        .withColumn("loss", F.array_join(chats.loss_texts(F.col("formatted"), F.col("mask")), ""))
        .select(
            "conv_id",
            F.size("turns").cast("bigint").alias("n_turns"),
            F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
            F.length("loss").cast("bigint").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("bigint").alias("formatted_chars"),
        )
    )


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.token_digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_near_copies(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["base"])
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", base.alias("base"), "pii").select(
        "doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("pii")).alias("spans")
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    return merkle.manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_passages": op2_passages,
    "op3_urls": op3_urls,
    "op4_bpe": op4_bpe,
    "op5_vectors": op5_vectors,
    "op6_chats": op6_chats,
    "op7_mix": op7_mix,
    "op8_simhash": op8_simhash,
    "op9_licenses": op9_licenses,
    "op10_pii": op10_pii,
    "op11_phrases": op11_phrases,
    "op12_manifest": op12_manifest,
    "op13_search": op13_search,
}
