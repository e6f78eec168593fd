"""Concept glossaries: CSV, JSON, and concept tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

CSV_SCHEMA = "column_name string, name string, description string, data_type string, max_length string"
JSON_SCHEMA = "column_name string, description string, data_type string, max_length string"
NO_LENGTH = -1


def _definitions(rows: DataFrame, order_column: str) -> DataFrame:
    """Typed definitions, the last one per column name in reading order."""
    length = F.when(F.length("max_length") > 0, F.col("max_length").cast("int")).otherwise(NO_LENGTH)
    typed = rows.select(
        "column_name",
        F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce("data_type", F.lit("")).alias("data_type"),
        F.coalesce(length, F.lit(NO_LENGTH)).alias("max_length"),
        F.col(order_column).alias("_order"),
    )
    latest = Window.partitionBy("column_name").orderBy(F.col("_order").desc())
    return typed.withColumn("_rn", F.row_number().over(latest)).filter("_rn = 1").drop("_rn", "_order")


def parse_glossary_csv(lines: DataFrame, order_column: str) -> DataFrame:
    """Definitions from CSV lines in ``value``; header lines are skipped and later lines win."""
    parsed = lines.select(order_column, F.from_csv("value", CSV_SCHEMA, {"quote": '"', "escape": '"'}).alias("r"))
    rows = parsed.select(order_column, "r.*").filter("column_name <> 'column_name'")
    return _definitions(rows, order_column)


def read_glossary_csv(spark: SparkSession, path: str) -> DataFrame:
    """Definitions from a CSV file with positional columns."""
    rows = spark.read.csv(path, schema=CSV_SCHEMA, header=False, quote='"', escape='"', multiLine=True)
    numbered = rows.withColumn("_line", F.monotonically_increasing_id()).filter("column_name <> 'column_name'")
    return _definitions(numbered, "_line")


def parse_glossary_json(objects: DataFrame, order_column: str) -> DataFrame:
    """Definitions from JSON objects in ``value``; the concept's name is its column name."""
    parsed = objects.select(order_column, F.from_json("value", JSON_SCHEMA).alias("r")).select(order_column, "r.*")
    return _definitions(parsed.withColumn("name", F.col("column_name")), order_column)


def read_glossary_json(spark: SparkSession, path: str) -> DataFrame:
    """Definitions from a JSON file holding one array of objects."""
    rows = spark.read.schema(JSON_SCHEMA).json(path, multiLine=True)
    numbered = rows.withColumn("_line", F.monotonically_increasing_id()).withColumn("name", F.col("column_name"))
    return _definitions(numbered, "_line")


def glossary_from_tables(concepts: DataFrame, implementations: DataFrame, data_form: str) -> DataFrame:
    """Concepts joined to their implementations in one data form.

    ``concepts``: id, name, description. ``implementations``: concept_id, column_name, type_id, max_length, data_form.
    """
    used = implementations.filter(F.col("data_form") == data_form).alias("i")
    return used.join(concepts.alias("c"), F.col("i.concept_id") == F.col("c.id")).select(
        F.col("c.name").alias("concept_name"), "c.description", "i.column_name", "i.type_id", "i.max_length"
    )
