"""Enriched catalog, concept matching and definition health.

Frames hold one row per column of the catalogued relations:
``catalog`` (node_key, database_name, schema_name, relation_name, column_name), ``models`` (node_key, description),
``model_columns`` (node_key, column_name, description), ``inventory`` (as built by ``inventory``), and ``glossary``
(column_name, name, description, data_type, max_length).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.common import own_shuffle, percentage

COLUMN_KEY = ("schema_name", "relation_name", "column_name")

# Texts of the reports.
NO_MODEL = "There is no model for this relation!"
NOT_IN_MODEL = "This column is not in the model for this relation!"
DOCUMENTATION_MISSING = "Skjölun vantar!"
TYPE_MESSAGE = "Gagnatýpa í skilgreiningu hugtaks: %s - Gagnatýpa í grunni: %s"
LENGTH_MESSAGE = "Lengd gagnatýpu í skilgreiningu hugtaks: %s - Lengd í grunni: %s"
NO_TESTS = "Engar prófanir skilgreindar fyrir dálk!"
ORIGIN_COLUMN = "Athugasemd við dálk"
ORIGIN_GLOSSARY = "Hugtök"
METADATA_MISSING = "Metadata missing!"
UNKNOWN_TYPE = "UNKNOWN"

# Type families.
TEXT_TYPES = ("char", "nchar", "varchar", "nvarchar")
NUMERIC_TYPES = ("int", "bigint", "tinyint", "smallint", "numeric", "float", "decimal", "double", "real")
# A column type without a length, and types that go by two names: the first is as good as the second.
UNBOUNDED_TEXT = "string"
SAME_TYPES = {"double": "float", "integer": "int", "long": "bigint", "boolean": "bit", "timestamp_ntz": "datetime2"}

KEY_SUFFIX = "_id"
KEY_CONCEPT = "id"
MIN_AFFIX_LENGTH = 3
NO_LENGTH = -1


def empty_glossary(columns: DataFrame) -> DataFrame:
    """The glossary of the type 'None': an empty definition for every column name."""
    looked_up = _glossary_key(F.col("column_name"))
    names = columns.groupBy(looked_up.alias("column_name"), own_shuffle(looked_up)).agg(F.lit(1))
    return names.select(
        "column_name",
        F.lit("").alias("name"),
        F.lit("").alias("description"),
        F.lit("").alias("data_type"),
        F.lit(None).cast("int").alias("max_length"),
    )


def _glossary_key(column_name: Column) -> Column:
    """Foreign keys share the definition of ``id``."""
    return F.when(column_name.endswith(KEY_SUFFIX), F.lit(KEY_CONCEPT)).otherwise(column_name)


def enrich_catalog(
    catalog: DataFrame, models: DataFrame, model_columns: DataFrame, inventory: DataFrame, glossary: DataFrame
) -> DataFrame:
    """Catalog columns with descriptions, physical type and glossary entry (NULLs where there is none)."""
    described = models.select("node_key", F.coalesce("description", F.lit("")).alias("_model"))
    columns = model_columns.select("node_key", "column_name", F.coalesce("description", F.lit("")).alias("_column"))
    types = inventory.select(
        *COLUMN_KEY,
        F.col("data_type").alias("type_name"),
        F.col("char_length").alias("max_length"),
        "numeric_precision",
        "numeric_scale",
    )
    # All keys meet the one concept ``id``: the concepts are shuffled for the join, so that this key can be split.
    concepts = glossary.groupBy(
        F.col("column_name").alias("_glossary_key"),
        F.col("name").alias("glossary_name"),
        F.col("description").alias("glossary_description"),
        F.col("data_type").alias("glossary_data_type"),
        F.col("max_length").alias("glossary_max_length"),
        own_shuffle("column_name"),
    ).agg(F.lit(1).alias("_one")).drop("_spread", "_one")
    return (
        catalog.join(described, "node_key", "left")
        .join(columns, ["node_key", "column_name"], "left")
        .join(types, list(COLUMN_KEY), "left")
        .join(concepts, _glossary_key(F.col("column_name")) == F.col("_glossary_key"), "left")
        .select(
            "database_name",
            *COLUMN_KEY,
            F.coalesce("_model", F.lit(NO_MODEL)).alias("relation_description"),
            F.coalesce("_column", F.lit(NOT_IN_MODEL)).alias("column_description"),
            "type_name",
            "max_length",
            "numeric_precision",
            "numeric_scale",
            "glossary_name",
            "glossary_description",
            "glossary_data_type",
            "glossary_max_length",
        )
    )


def glossary_best_match(concepts: DataFrame, inventory: DataFrame) -> DataFrame:
    """The best concept per inventory column, or empty texts, length -1 and match type 0.

    ``concepts``: concept_name, description, column_name, type_id, max_length. Match types: 1 equal names; 2 name is
    the concept and ``_id``; 3 concept is a prefix; 4 a suffix; 5 a suffix before ``_id`` (3 to 5 for concepts of
    three and more characters). The lowest type wins, then the longest concept, then alphabetical order.

    A concept is compared literally. Every affix of a distinct column name becomes a row, so all five rules are one
    equi-join instead of a comparison of all columns with all concepts. The merge hint keeps the exploded rows from
    being broadcast on the size they had before.
    """
    name = F.col("column_name")
    size = F.length(name)
    is_key = name.endswith(KEY_SUFFIX)
    stem = F.substr(name, F.lit(1), size - len(KEY_SUFFIX))

    def probes(rank: int, texts: Column) -> Column:
        return F.transform(texts, lambda t: F.struct(F.lit(rank).alias("match_type_id"), t.alias("probe")))

    def lengths(longest: Column) -> Column:
        empty = F.array().cast("array<int>")
        return F.when(longest >= MIN_AFFIX_LENGTH, F.sequence(F.lit(MIN_AFFIX_LENGTH), longest)).otherwise(empty)

    no_text = F.array().cast("array<string>")
    prefixes = F.transform(lengths(size - 1), lambda n: F.left(name, n))
    suffixes = F.transform(lengths(size - 1), lambda n: F.right(name, n))
    key_suffixes = F.when(is_key, F.transform(lengths(F.length(stem)), lambda n: F.right(stem, n))).otherwise(no_text)
    candidates = F.concat(
        probes(1, F.array(name)),
        probes(2, F.when(is_key, F.array(stem)).otherwise(no_text)),
        probes(3, prefixes),
        probes(4, suffixes),
        probes(5, key_suffixes),
    )
    names = inventory.select("column_name").distinct()
    probed = names.select("column_name", F.inline(candidates))
    known = concepts.select(
        "concept_name", "description", F.lower("type_id").alias("data_type"), "max_length",
        F.col("column_name").alias("matched_column_name"),
    )
    preference = F.struct(
        "match_type_id", -F.length("matched_column_name"), "matched_column_name", "concept_name"
    )
    best = (
        probed.hint("merge").join(known, F.col("probe") == F.col("matched_column_name"))
        .groupBy("column_name", own_shuffle("column_name"))
        .agg(
            F.min_by(
                F.struct("concept_name", "description", "data_type", "max_length", "match_type_id", "matched_column_name"),
                preference,
            ).alias("b")
        )
        .drop("_spread")
    )
    return inventory.select(*COLUMN_KEY).join(best, "column_name", "left").select(
        *COLUMN_KEY,
        F.coalesce("b.concept_name", F.lit("")).alias("concept_name"),
        F.coalesce("b.description", F.lit("")).alias("description"),
        F.coalesce("b.data_type", F.lit("")).alias("data_type"),
        F.coalesce("b.max_length", F.lit(NO_LENGTH)).alias("max_length"),
        F.coalesce("b.match_type_id", F.lit(0)).alias("match_type_id"),
        F.coalesce("b.matched_column_name", F.lit("")).alias("matched_column_name"),
    )


# Conditions on a row of the enriched catalog.


def _filled(column: str) -> Column:
    return F.length(F.coalesce(F.col(column), F.lit(""))) > 0


def undocumented() -> Column:
    return ~_filled("column_description") & ~_filled("glossary_description")


def overwrites_concept(schemas: Sequence[str] | None = None) -> Column:
    both = _filled("column_description") & _filled("glossary_description")
    condition = both & ~F.col("glossary_name").eqNullSafe(F.lit(KEY_CONCEPT))
    return condition & F.col("schema_name").isin(*schemas) if schemas is not None else condition


def type_error_message() -> Column:
    """Message where the physical type, or a text type's length, differs from the glossary's; else NULL."""
    wanted = F.lower("glossary_data_type")
    actual = F.coalesce(F.lower("type_name"), F.lit(UNKNOWN_TYPE))
    lengths_differ = ~F.col("glossary_max_length").eqNullSafe(F.col("max_length"))
    other_name = F.lit(False)
    for one, two in SAME_TYPES.items():
        other_name = other_name | ((actual == one) & (wanted == two))
    unbounded = (actual == UNBOUNDED_TEXT) & wanted.isin(*TEXT_TYPES, "text")
    return F.when(
        _filled("glossary_data_type"),
        F.when((wanted != actual) & ~other_name & ~unbounded, F.format_string(TYPE_MESSAGE, wanted, actual)).when(
            wanted.isin(*TEXT_TYPES) & ~unbounded & lengths_differ,
            F.format_string(LENGTH_MESSAGE, F.col("glossary_max_length"), F.col("max_length")),
        ),
    )


def _errors(df: DataFrame, message: Column) -> DataFrame:
    return df.select(*COLUMN_KEY, message.alias("message")).orderBy(*COLUMN_KEY)


def public_only(enriched: DataFrame, public_schemas: Sequence[str]) -> DataFrame:
    return enriched.filter(F.col("schema_name").isin(*public_schemas))


def documentation_errors(enriched: DataFrame) -> DataFrame:
    """Columns that neither their model nor the glossary describes."""
    return _errors(enriched.filter(undocumented()), F.lit(DOCUMENTATION_MISSING))


def concept_overwrites(enriched: DataFrame, schemas: Sequence[str] | None = None) -> DataFrame:
    """Columns with a description of their own although the glossary has one (keys excepted)."""
    rows = enriched.filter(overwrites_concept(schemas))
    return rows.select(*COLUMN_KEY, F.col("glossary_name").alias("concept_name")).orderBy(*COLUMN_KEY)


def type_errors(enriched: DataFrame) -> DataFrame:
    """Columns whose physical type disagrees with the glossary."""
    return _errors(enriched.filter(type_error_message().isNotNull()), type_error_message())


RELATION_KEY = ("database_name", "schema_name", "relation_name")


def relation_test_coverage(tests: DataFrame) -> DataFrame:
    """Number of tests per relation. ``tests``: database, schema, relation, and column (NULL for several columns).
    Tests without a relation count nowhere."""
    return tests.filter("relation_name is not null").groupBy(*RELATION_KEY).agg(F.count("*").alias("test_count"))


def column_test_coverage(tests: DataFrame) -> DataFrame:
    """Number of tests per column."""
    single = tests.filter("column_name is not null and relation_name is not null")
    return single.groupBy(*RELATION_KEY, "column_name").agg(F.count("*").alias("test_count"))


def test_coverage_errors(
    enriched: DataFrame, tests: DataFrame, schemas: Sequence[str] | None = None
) -> DataFrame:
    """Columns without any test."""
    wanted = public_only(enriched, schemas) if schemas is not None else enriched
    uncovered = wanted.join(column_test_coverage(tests), [*RELATION_KEY, "column_name"], "left_anti")
    return _errors(uncovered, F.lit(NO_TESTS))


def definition_stats(
    enriched: DataFrame,
    tests: DataFrame,
    public_schemas: Sequence[str],
    concept_schemas: Sequence[str] | None = None,
    test_schemas: Sequence[str] | None = None,
) -> DataFrame:
    """Columns, good columns and errors per relation, and overall (the row with NULL names).

    A column is good without documentation, type and test error. Errors of all kinds are added up, so their share
    can pass 100 %. Shares are 0 without columns.
    """
    tested = column_test_coverage(tests).select(*RELATION_KEY, "column_name", F.lit(True).alias("_tested"))
    needs_test = F.col("schema_name").isin(*test_schemas) if test_schemas is not None else F.lit(True)
    flagged = (
        public_only(enriched, public_schemas)
        .join(tested, [*RELATION_KEY, "column_name"], "left")
        .select(
            "schema_name",
            "relation_name",
            undocumented().cast("int").alias("_doc"),
            overwrites_concept(concept_schemas).cast("int").alias("_over"),
            type_error_message().isNotNull().cast("int").alias("_type"),
            (F.col("_tested").isNull() & needs_test).cast("int").alias("_test"),
        )
    )
    errors = F.col("_doc") + F.col("_type") + F.col("_test")
    per_relation = flagged.groupBy("schema_name", "relation_name").agg(
        F.lit(1).cast("bigint").alias("relation_count"),
        F.count("*").alias("column_count"),
        F.sum("_over").alias("overwrite_count"),
        F.count_if(errors == 0).alias("ok_count"),
        F.sum(errors).alias("error_count"),
        F.sum("_type").alias("type_error_count"),
        F.sum("_doc").alias("documentation_error_count"),
        F.sum("_test").alias("test_error_count"),
    )
    names = [F.lit(None).cast("string").alias(c) for c in ("schema_name", "relation_name")]
    sums = [F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c) for c in per_relation.columns[2:]]
    counted = per_relation.unionByName(per_relation.agg(*sums).select(*names, "*"))

    def share(count: str) -> Column:
        return F.coalesce(percentage(F.col(count), F.col("column_count"), 2), F.lit(0.0))

    kinds = ("overwrite", "ok", "error", "type_error", "documentation_error", "test_error")
    measures = [c for k in kinds for c in (F.col(f"{k}_count"), share(f"{k}_count").alias(f"{k}_percentage"))]
    return counted.select("schema_name", "relation_name", "relation_count", "column_count", *measures).orderBy(
        "schema_name", "relation_name"
    )


def length_text() -> Column:
    """Length of text types, ``digits before the point, scale`` of numeric ones."""
    kind = F.col("type_name")
    before = (F.col("numeric_precision") - F.col("numeric_scale")).cast("string")
    return (
        F.when(kind.isNull(), F.lit(METADATA_MISSING))
        .when(kind.isin(*TEXT_TYPES, UNBOUNDED_TEXT), F.col("max_length").cast("string"))
        .when(kind.isin(*NUMERIC_TYPES), F.concat(before, F.lit(", "), F.col("numeric_scale").cast("string")))
        .otherwise(F.lit(""))
    )


def documentation_table(enriched: DataFrame, public_schemas: Sequence[str]) -> DataFrame:
    """User documentation: type, length, description and where it comes from (a column's own note wins)."""
    own, shared = _filled("column_description"), _filled("glossary_description")
    return (
        public_only(enriched, public_schemas)
        .select(
            *COLUMN_KEY,
            "relation_description",
            F.coalesce("type_name", F.lit(UNKNOWN_TYPE)).alias("type_name"),
            length_text().alias("type_length"),
            F.when(own, F.col("column_description")).when(shared, F.col("glossary_description")).alias("description"),
            F.when(own, F.lit(ORIGIN_COLUMN)).when(shared, F.lit(ORIGIN_GLOSSARY)).alias("origin"),
            (~own & ~shared).cast("int").alias("missing"),
        )
        .orderBy(*COLUMN_KEY)
    )
