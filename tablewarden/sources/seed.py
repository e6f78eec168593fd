"""Seed files: a header line, then every value as quoted text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def seed_header(df: DataFrame) -> str:
    return ",".join(df.columns)


def seed_lines(df: DataFrame) -> DataFrame:
    """One quoted line per row; NULL becomes an empty quoted field instead of losing the whole line."""
    quoted = [F.concat(F.lit('"'), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"')) for c in df.columns]
    return df.select(F.concat_ws(",", *quoted).alias("line"))


def export_seed(df: DataFrame, path: str) -> None:
    """Write the table as CSV parts with header, every field quoted."""
    texts = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    texts.write.mode("overwrite").csv(path, header=True, quoteAll=True, emptyValue="")
