"""Column inventories and row counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

INVENTORY_SCHEMA = T.StructType(
    [
        T.StructField("schema_name", T.StringType(), False),
        T.StructField("relation_name", T.StringType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("char_length", T.IntegerType(), False),
        T.StructField("numeric_precision", T.IntegerType(), False),
        T.StructField("numeric_scale", T.IntegerType(), False),
        T.StructField("is_view", T.BooleanType(), False),
    ]
)

# Decimal digits that hold every value of an integer type; bits of the mantissa for floating point.
PRECISION = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19, "float": 24, "double": 53}
UNBOUNDED = -1


def _declared_length(field: T.StructField) -> int:
    """Declared text length: n for ``varchar(n)`` and ``char(n)``, -1 for plain text, 0 for other types."""
    if isinstance(field.dataType, (T.VarcharType, T.CharType)):
        return field.dataType.length
    declared = field.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "")
    if "(" in declared:
        return int(declared[declared.index("(") + 1 : declared.index(")")])
    return UNBOUNDED if isinstance(field.dataType, T.StringType) else 0


def _type_name(field: T.StructField) -> str:
    declared = field.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "")
    name = declared or field.dataType.simpleString()
    return name.split("(")[0]


def column_inventory(
    spark: SparkSession, tables: Mapping[tuple[str, str], DataFrame], views: frozenset[tuple[str, str]] = frozenset()
) -> DataFrame:
    """One row per column of the given (schema, relation) -> DataFrame, from the schemas alone."""
    rows = []
    for (schema, relation), df in tables.items():
        for ordinal, field in enumerate(df.schema.fields, 1):
            kind = _type_name(field)
            precision, scale = PRECISION.get(kind, 0), 0
            if isinstance(field.dataType, T.DecimalType):
                precision, scale = field.dataType.precision, field.dataType.scale
            rows.append(
                (schema, relation, field.name, ordinal, kind, _declared_length(field), precision, scale,
                 (schema, relation) in views)
            )
    return spark.createDataFrame(rows, INVENTORY_SCHEMA)


def _measured(schema: str, relation: str, df: DataFrame) -> DataFrame:
    """Per column of one relation: filled rows and longest text, from one scan."""
    measures = []
    for field in df.schema.fields:
        name = "`" + field.name.replace("`", "``") + "`"
        longest = f"max(length({name}))" if isinstance(field.dataType, T.StringType) else "cast(null as int)"
        measures.append(F.expr(f"struct(count(*) as row_count, count({name}) as filled_rows, {longest} as longest_text) as {name}"))
    wide = df.agg(*measures)
    return wide.unpivot([], [F.col("`" + c.replace("`", "``") + "`") for c in wide.columns], "column_name", "m").select(
        F.lit(schema).alias("schema_name"), F.lit(relation).alias("relation_name"), "column_name", "m.*"
    )


def measured_inventory(spark: SparkSession, tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """The inventory with what the data shows: rows, filled rows and longest text per column."""
    measured = reduce(DataFrame.unionByName, [_measured(s, r, df) for (s, r), df in tables.items()])
    return column_inventory(spark, tables).join(measured, ["schema_name", "relation_name", "column_name"])


def unbounded_strings(inventory: DataFrame) -> DataFrame:
    """Text columns without a declared length; over a measured inventory, with the longest text they hold."""
    return inventory.filter(F.col("char_length") == UNBOUNDED)


def cardinality(spark: SparkSession, tables: Mapping[tuple[str, str, str], DataFrame | None]) -> DataFrame:
    """Row count per (database, schema, relation) in one job; a relation that could not be read (None) counts -1."""
    parts = []
    for (database, schema, relation), df in tables.items():
        counted = spark.range(1).select(F.lit(-1).cast("bigint").alias("row_count")) if df is None else df.agg(
            F.count("*").alias("row_count")
        )
        parts.append(
            counted.select(
                F.lit(database).alias("database_name"),
                F.lit(schema).alias("schema_name"),
                F.lit(relation).alias("relation_name"),
                "row_count",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def readable(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at a path, or None when it cannot be read."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None
