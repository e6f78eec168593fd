"""The registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe_codec, decontaminate, html_extract, language_spans, line_dedup, ngram_join, personal_data, quality_rules, repeats,
    secret_scan, spelling, sql, token_alignment, toxicity,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def oracle(statement: str):
    def register(build):
        ORACLES[build.__name__] = statement
        return query(build)

    return register


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts by kind, a digest of the pattern spans, and all spans."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s.startswith(f"{kind}:"))).cast("long")

    base = F.filter("spans", lambda s: ~s.startswith("literal:"))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"), F.concat_ws(",", "spans").alias("spans"),
        count("literal").alias("n_literal"),
    )


def fold(parts: int) -> Column:
    """Which of ``parts`` folds a document belongs to."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of four folds of five."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs.where(fold(5) != 0), table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@oracle(sql.DECONTAMINATION)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items, and those items."""
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in 400-byte strings which occur again, and a digest of the others."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main language of every document, learned from three folds of four, with the language spans."""
    docs = table(spark, sf_dir, "documents")
    model = language_spans.train(docs.where(fold(4) != 2))
    return language_spans.label_languages(docs, model).select(
        "doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score",
        F.size("spans").alias("n_spans"),
    )


@oracle(sql.NGRAM_CLASSES)
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set sizes and connected classes of near-duplicate documents."""
    found = ngram_join.jaccard_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, tokenizer measures and verdict of every document."""
    found = quality_rules.quality_signals(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "chars_per_token", "byte_share", "entropy",
    )


@oracle(sql.LINE_DEDUP)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, those removed as near copies of earlier ones, and a digest of the others."""
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: token counts and digests of ids and of the decoded text."""
    coded = bpe_codec.encode_texts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), decoded=True
    )
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@oracle(sql.SPELLING)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their number of near words, the form each is led to and the root of the chain."""
    return spelling.group_variants(table(spark, sf_dir, "documents"))


@query
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts of the plain patterns by kind and a digest of their spans, and all spans."""
    found = personal_data.find_personal_data(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("plain", lambda s: s.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind in personal_data.KINDS], F.sha2(F.concat_ws(",", "plain"), 256).alias("base_sha256"),
        F.concat_ws(",", "spans").alias("spans"), (F.size("spans") - F.size("plain")).cast("long").alias("n_disguised"),
    )


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two vocabularies in every document, and how frequent the links are."""
    found = token_alignment.score_alignments(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), digest=True,
    )
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )
