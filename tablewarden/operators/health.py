"""Data health: roll-ups of check results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.common import own_shuffle, percentage
from ..sources.run_files import MISSING_SQL, UNKNOWN

LEVELS = ("database_name", "schema_name", "relation_name")


def _counts() -> list[Column]:
    result = F.col("result")
    return [
        F.count_if(result == "pass").alias("ok_count"),
        F.count_if(result == "warn").alias("warning_count"),
        F.count_if(result == "fail").alias("fail_count"),
    ]


def _with_percentages(df: DataFrame, leading: list[str]) -> DataFrame:
    """Total of the three counted outcomes and their shares; a group with no counted outcome has NULL shares."""
    total = F.col("ok_count") + F.col("warning_count") + F.col("fail_count")
    return df.withColumn("total_count", total).select(
        *leading,
        "ok_count",
        percentage(F.col("ok_count"), F.col("total_count"), 2).alias("ok_percentage"),
        "warning_count",
        percentage(F.col("warning_count"), F.col("total_count"), 2).alias("warning_percentage"),
        "fail_count",
        percentage(F.col("fail_count"), F.col("total_count"), 2).alias("fail_percentage"),
        "total_count",
    )


def _stats(results: DataFrame, keys: list[str]) -> DataFrame:
    return _with_percentages(results.groupBy(*keys).agg(*_counts()), keys)


def relation_stats(results: DataFrame) -> DataFrame:
    """Passes, warnings and failures per relation; other outcomes count nowhere."""
    return _stats(results, list(LEVELS))


def schema_stats(results: DataFrame) -> DataFrame:
    return _stats(results, list(LEVELS[:2]))


def database_stats(results: DataFrame) -> DataFrame:
    return _stats(results, list(LEVELS[:1]))


def overall_stats(results: DataFrame) -> DataFrame:
    return _stats(results, [])


def health_rollup(results: DataFrame) -> DataFrame:
    """All four levels in one rollup; ``level`` tells them apart."""
    depth = F.grouping_id()
    level = F.when(depth == 0, "relation").when(depth == 1, "schema").when(depth == 3, "database").otherwise("overall")
    rolled = results.rollup(*LEVELS).agg(level.alias("level"), *_counts())
    return _with_percentages(rolled, ["level", *LEVELS])


def _row_counts(cardinality: DataFrame) -> DataFrame:
    """One row count per relation, free to be joined by shuffle when a relation has most of the entries."""
    counts = cardinality.groupBy(*LEVELS, own_shuffle(*LEVELS)).agg(F.max("row_count").alias("rows_in_relation"))
    return counts.drop("_spread")


def error_list(errors: DataFrame, cardinality: DataFrame | None = None) -> DataFrame:
    """Failed checks with the share of violating rows.

    ``cardinality`` (database, schema, relation, row_count) replaces the row count noted in ``errors``. An unknown
    count, kept as -1, gives a NULL share.
    """
    if cardinality is not None:
        errors = errors.drop("rows_in_relation").join(_row_counts(cardinality), list(LEVELS), "left")
        errors = errors.withColumn("rows_in_relation", F.coalesce("rows_in_relation", F.lit(-1).cast("bigint")))
    # Sorting samples its input first; the rebalance keeps that from running the checks' plans twice.
    return _error_rows(errors.hint("rebalance")).orderBy(*LEVELS, "test_name", "unique_id")


def _error_rows(errors: DataFrame) -> DataFrame:
    rows = F.col("rows_in_relation")
    return errors.select(
        *LEVELS,
        "test_name",
        "unique_id",
        "sql_filename",
        "rows_on_error",
        F.when(rows >= 0, percentage(F.col("rows_on_error"), rows, 4)).alias("error_percentage"),
        "rows_in_relation",
        "query_path",
        "sql",
    )


def attribute_tests(log: DataFrame, manifest: DataFrame) -> DataFrame:
    """Check-log entries with the database, schema, relation and query text of their manifest test.

    A test that several manifests hold counts once; an entry without a test stays, in an unknown relation.
    """
    fields = ("database_name", "schema_name", "relation_name", "sql_filename", "query_path", "sql")
    tests = manifest.groupBy("unique_id", own_shuffle("unique_id")).agg(F.min(F.struct(*fields)).alias("test"))
    joined = log.drop("sql_filename").join(tests.drop("_spread"), "unique_id", "left")
    unknown = {name: UNKNOWN for name in LEVELS} | {"sql": MISSING_SQL}
    return joined.select(
        *log.drop("sql_filename").columns,
        *[F.coalesce(f"test.{f}", F.lit(unknown[f])).alias(f) if f in unknown else F.col(f"test.{f}").alias(f)
          for f in fields],
    )


def attributed_results(attributed: DataFrame) -> DataFrame:
    return attributed.select(*LEVELS, "test_name", "unique_id", F.col("status").alias("result"))


def attributed_errors(attributed: DataFrame, cardinality: DataFrame) -> DataFrame:
    """Failed entries in the shape :func:`error_list` reads; a relation without a row count gets -1."""
    failed = attributed.filter("status = 'fail'")
    return failed.join(_row_counts(cardinality), list(LEVELS), "left").select(
        *LEVELS,
        "test_name",
        "unique_id",
        "sql_filename",
        F.col("num_failures").alias("rows_on_error"),
        F.coalesce("rows_in_relation", F.lit(-1).cast("bigint")).alias("rows_in_relation"),
        "query_path",
        "sql",
    )


def _summary() -> Column:
    """The four count and percentage pairs of a report level, from its counts."""
    total = F.col("ok_count") + F.col("warning_count") + F.col("fail_count")

    def pair(count: str) -> Column:
        return F.struct(F.col(count).alias("count"), percentage(F.col(count), total, 2).alias("percentage"))

    return F.struct(
        pair("ok_count").alias("ok"),
        pair("warning_count").alias("warning"),
        pair("fail_count").alias("error"),
        F.struct(total.alias("count"), F.lit(100.0).alias("percentage")).alias("total"),
    )


def _lift(level: DataFrame, keys: list[str], name: str, children: list[str], into: str) -> DataFrame:
    """The next level up: sums, and a sorted list of this level's entries."""
    entry = F.struct(F.col(name).alias("name"), _summary().alias("summary"), *children)
    sums = [F.sum(c).alias(c) for c in ("ok_count", "warning_count", "fail_count")]
    return level.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias(into), *sums)


def _databases(results: DataFrame) -> DataFrame:
    relations = results.groupBy(*LEVELS).agg(*_counts())
    schemas = _lift(relations, ["database_name", "schema_name"], "relation_name", [], "relations")
    return _lift(schemas, ["database_name"], "schema_name", ["relations"], "schemas")


def health_report(results: DataFrame) -> DataFrame:
    """One row per database: its summary, and its schemas with their relations as nested lists.

    Each level sums the one below it, so the results are read once. Lists hold one entry per relation, never table
    rows.
    """
    return _databases(results).select("database_name", _summary().alias("summary"), "schemas")


def health_document(api_name: str, results: DataFrame, errors: DataFrame, header: DataFrame) -> DataFrame:
    """The whole report as one nested row: header of the newest run, statistics of all levels, failed checks.

    It holds one entry per relation and per failed check.
    """
    everything = _lift(_databases(results), [], "database_name", ["schemas"], "databases")
    failed = _error_rows(errors)
    listed = failed.agg(F.sort_array(F.collect_list(F.struct(*failed.columns))).alias("errors")).scalar()
    run = header.agg(F.max_by(F.struct("version", "executed_at", "invocation_id"), F.struct("executed_at", "invocation_id")))
    return everything.select(
        F.lit(api_name).alias("api_name"),
        run.scalar().alias("header"),
        F.struct(_summary().alias("summary"), "databases").alias("stats"),
        listed.alias("errors"),
    )


# The columns of the report's files, for readers that must not guess them.
REPORT_SCHEMAS = {
    "header": "api_name string, version string, executed_at string, invocation_id string",
    "statistics": "level string, database_name string, schema_name string, relation_name string, ok_count bigint, "
    "ok_percentage double, warning_count bigint, warning_percentage double, fail_count bigint, fail_percentage double, "
    "total_count bigint",
    "errors": "test_name string, unique_id string, sql_filename string, rows_on_error bigint, error_percentage double, "
    "rows_in_relation bigint, query_path string, sql string, database_name string, schema_name string, "
    "relation_name string",
}


def write_report(api_name: str, results: DataFrame, errors: DataFrame, header: DataFrame, root: str) -> dict[str, str]:
    """The report of :func:`health_document` as JSON lines below ``root``; returns the folder of each part.

    ``header`` holds one row, ``statistics`` one per relation, schema and database and one for all, ``errors`` one per
    failed check in a folder per relation. Executors write them; no row holds a list, so a report may have any number of
    failed checks. A repeated run replaces the folders.
    """
    newest = F.max_by(F.struct("version", "executed_at", "invocation_id"), F.struct("executed_at", "invocation_id"))
    run = header.agg(newest.alias("run")).select(F.lit(api_name).alias("api_name"), "run.*")
    parts = {
        "header": run.withColumn("executed_at", F.col("executed_at").cast("string")).write,
        "statistics": health_rollup(results).write,
        "errors": _error_rows(errors).hint("rebalance", *LEVELS).write.partitionBy(*LEVELS),
    }
    paths = {}
    for name, writer in parts.items():
        paths[name] = f"{root}/{name}"
        writer.mode("overwrite").json(paths[name])
    return paths


def read_report(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The parts of a written report. Only the folders of a relation are opened where its names are given."""
    return {name: spark.read.schema(REPORT_SCHEMAS[name]).json(path) for name, path in paths.items()}
