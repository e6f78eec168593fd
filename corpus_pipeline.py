"""The corpus pipeline: five stages over ``documents``, each on what the one before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes it as Parquet to the shared folder
and reads it back for the next. All but the last return the columns of ``documents``. NULL texts are documents without words: the quality rules reject them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.llm import bpe_codec, decontaminate, line_dedup, ngram_join, quality_rules
from tablewarden.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    found = quality_rules.quality_signals(
        docs, public_tokenizers.path("piece_bpe_32k.model"), keep=COLUMNS
    )
    return found.where("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are near copies of earlier ones; those that lose all lines go."""
    found = line_dedup.dedup_lines(docs, carry=("lang", "source"))
    return found.where("n_lines > n_removed").select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id, and of texts that share this id the
    one with the smallest hash. Rows with one id and unrelated texts are different documents. Rows without an id can't be
    named by a verdict and stay."""
    mark = F.struct("doc_id", F.xxhash64("text").alias("mark"))
    marked = docs.withColumn("row_key", F.when(F.col("doc_id").isNotNull(), mark))
    found = ngram_join.jaccard_classes(marked, key="row_key")
    first = found.where(F.col("row_key") == F.col("component")).select("row_key").distinct()
    kept = marked.join(first, "row_key", "left_semi").groupBy("row_key").agg(  # already dealt out by the key
        F.min(F.struct("text", "lang", "source", "n_chars")).alias("row")
    ).select("row_key.doc_id", "row.*")
    return kept.select(*COLUMNS).union(docs.where(F.col("doc_id").isNull()).select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), carry=("text", "lang", "source", "n_chars"))
    return found.where(~F.col("contaminated")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of the text that they decode to."""
    found = bpe_codec.encode_texts(
        docs, public_tokenizers.path("word_bpe_49k.json"), keep=("doc_id", "lang", "source"), decoded=True
    )
    return found.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: The tokenizer stages have no SQL form; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
