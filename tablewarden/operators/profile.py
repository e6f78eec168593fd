"""Profiles of a table: distinct values, storage order, row search, footprint."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def distinct_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, fewest first.

    Exact counts aggregate each column on its own: parquet reads one column per branch, so the table is read once
    in total, and no row is expanded into one wide row per column as several ``count(distinct)`` in one aggregate
    would. ``approximate`` takes one scan with a fixed-size sketch per column instead.
    """
    if approximate:
        sketches = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
        rows = [
            F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("distinct_values"), F.lit(i + 1).alias("ordinal"))
            for i, c in enumerate(df.columns)
        ]
        counted = sketches.select(F.inline(F.array(*rows)))
    else:
        branches = [
            df.select(F.col(f"`{c}`").alias("v"))
            .filter("v is not null")
            .distinct()
            .agg(F.count("*").alias("distinct_values"))
            .select(F.lit(c).alias("column_name"), "distinct_values", F.lit(i).alias("ordinal"))
            for i, c in enumerate(df.columns, 1)
        ]
        counted = reduce(DataFrame.unionByName, branches)
    return counted.orderBy("distinct_values", "ordinal")


# Profiles over time: a sketch per column and day is stored once, and any range of days is answered from the sketches.

SKETCH_BITS = 12  # 4,096 registers: a standard error of 1.6 %, some kilobytes per column and day


def profile_sketches(df: DataFrame, date_column: str, bits: int = SKETCH_BITS) -> DataFrame:
    """Per day and column: rows, filled rows and a mergeable sketch of the distinct values, in one scan.

    Tasks sketch before the shuffle, so what moves and what is kept depends on days and columns, not on rows. Rows
    without a day form the day NULL. Values are sketched as text behind a mark, since sketches skip empty texts.
    """
    columns = [c for c in df.columns if c != date_column]

    def measured(column: str) -> Column:
        value = F.col(f"`{column}`").cast("string")
        return F.struct(
            F.count(value).alias("filled_rows"), F.hll_sketch_agg(F.concat(F.lit(":"), value), F.lit(bits)).alias("sketch")
        )

    wide = df.groupBy(F.to_date(F.col(f"`{date_column}`")).alias("day")).agg(
        F.count("*").alias("row_count"), *[measured(c).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(i + 1).alias("ordinal"), F.col(f"c{i}.filled_rows"), F.col(f"c{i}.sketch"))
        for i, c in enumerate(columns)
    ]
    return wide.select("day", "row_count", F.inline(F.array(*rows)))


def store_profile(df: DataFrame, date_column: str, path: str, bits: int = SKETCH_BITS) -> None:
    """Write the sketches in a folder per day. Days of ``df`` are replaced, other days of the folder stay, so each new
    day of a table is profiled once, and a repeated run gives the same folder."""
    sketches = profile_sketches(df, date_column, bits)
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def profile_of_days(sketches: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Rows, filled rows and distinct values per column over the days ``first`` to ``last``, fewest distinct first.

    Stored sketches are merged; the table is not read. On a folder of :func:`store_profile` only the named days are
    opened. A column that a day's sketches lack counts no rows on that day. Without both bounds the day NULL counts too.
    """
    for bound, condition in ((first, F.col("day") >= F.lit(first)), (last, F.col("day") <= F.lit(last))):
        if bound is not None:
            sketches = sketches.filter(condition)
    merged = sketches.groupBy("column_name").agg(
        F.max("ordinal").alias("ordinal"), F.sum("row_count").alias("row_count"), F.sum("filled_rows").alias("filled_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))).alias("distinct_values"),
    )
    return merged.select("column_name", "distinct_values", "ordinal", "row_count", "filled_rows").orderBy("distinct_values", "ordinal")


def storage_order(profile: DataFrame) -> DataFrame:
    """The columns in clustering order as one text (one element per column)."""
    ordered = F.sort_array(F.collect_list(F.struct("distinct_values", "ordinal", "column_name")))
    names = F.transform(ordered, lambda e: F.concat(F.lit("["), e["column_name"], F.lit("]")))
    return profile.agg(F.array_join(names, ", ").alias("order_clause"))


def cluster_by_cardinality(df: DataFrame, path: str, partitions: int | None = None, approximate: bool = False) -> list[str]:
    """Rewrite the table sorted by its columns, fewest distinct values first, which packs best; returns the order.

    Counts are exact; ``approximate`` takes one scan with sketches, and columns of close counts may change places.
    Range partitioning samples all sort columns, so a frequent value of the first ones is spread over partitions.
    """
    order = [row["column_name"] for row in distinct_profile(df, approximate).collect()]
    columns = [F.col(f"`{c}`") for c in order]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    ranged.sortWithinPartitions(*columns).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return order


def row_search(df: DataFrame, needle: str, fold_case: bool = False) -> DataFrame:
    """Whole rows as text, columns joined by ``||`` with NULLs skipped, that contain the needle."""
    text = F.concat_ws("||", *[F.col(f"`{c}`").cast("string") for c in df.columns])
    rows = df.select(text.alias("row_text"))
    if fold_case:
        return rows.filter(F.contains(F.lower("row_text"), F.lit(needle.lower())))
    return rows.filter(F.col("row_text").contains(needle))


def footprint(tables: Mapping[tuple[str, str], DataFrame], minimum_mb: float = 100.0) -> DataFrame:
    """Files, partitions, rows and megabytes per table, largest first, from a threshold on.

    Row counts come from file footers: no column is read.
    """
    parts = []
    for (schema, relation), df in tables.items():
        files = df.select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
        ).groupBy("path", "size").agg(F.count("*").alias("rows"))
        parts.append(
            files.agg(
                F.countDistinct(F.regexp_replace("path", "/[^/]+$", "")).alias("partition_count"),
                F.count("*").alias("file_count"),
                F.sum("rows").alias("row_count"),
                F.sum("size").alias("total_bytes"),
            ).select(F.lit(schema).alias("schema_name"), F.lit(relation).alias("relation_name"), "*")
        )
    megabytes = F.col("total_bytes") / (1024 * 1024)
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("total_space_mb", F.round(megabytes, 2))
        .withColumn("rows_per_mb", F.floor(F.try_divide(F.col("row_count"), megabytes)))
        .filter(megabytes >= minimum_mb)
        .orderBy(F.col("total_bytes").desc(), "relation_name")
    )
