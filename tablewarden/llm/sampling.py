"""A bounded sample of labelled texts, the same for the same rows however they are dealt out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame, text: str, label: str, rows_per_label: int, labels: DataFrame | None = None, key: str = "doc_id"
) -> list[tuple[object, str]]:
    """At most ``rows_per_label`` different texts of each label, as (label, text).

    The label is a column of ``docs``, or of ``labels``, which is then joined on ``key``. Texts are dealt into as many
    buckets by their hash, and the smallest hash of each bucket stays: an aggregate with one value per label and bucket,
    so no label's rows meet in one task, and only the chosen texts move. Rows without a label or a text are left out.
    """
    texts = docs.select(F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("mark")).where(
        F.col("text").isNotNull()
    )
    if labels is None:
        marked = docs.select(F.col(f"`{label}`").alias("label"), F.xxhash64(F.col(f"`{text}`")).alias("mark"),
                             F.col(f"`{text}`").isNotNull().alias("there"))
    else:
        marked = docs.select(
            F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("mark"),
            F.col(f"`{text}`").isNotNull().alias("there"),
        ).join(labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label")), "key")
    chosen = (
        marked.where(F.col("label").isNotNull() & F.col("there"))
        .groupBy("label", F.pmod("mark", F.lit(rows_per_label)).alias("bucket"))
        .agg(F.min("mark").alias("mark")).drop("bucket")
    )
    # One row per label and bucket, all of which come to the driver below: small enough to broadcast.
    found = texts.join(F.broadcast(chosen), "mark").groupBy("label", "mark").agg(F.min("text").alias("text"))
    return [(r.label, r.text) for r in sorted(found.collect(), key=lambda r: (str(r.label), r.mark))]
