"""The daily run as one job: snapshots, checks, health, errors with their rows.

Every step's result is written below the run's folder and read back by the next one, so a lost executor costs a
step's tasks and never an earlier step, and a repeated run rewrites the same folders.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..operators import health, history, suite
from ..sources import storage


def run_daily(
    spark: SparkSession,
    relations: Iterable[suite.Relation],
    checks: Iterable[suite.Check],
    root: str,
    run_date: date,
    snapshots: Mapping[str, DataFrame] | None = None,
    snapshot_schema: str = "snapshot",
    history_schema: str = "history",
    date_column: str = "snapshot_date",
    keep_violations: bool = True,
) -> dict[str, str]:
    """Run the day and return the path of every written dataset."""
    relations, checks = list(relations), list(checks)
    if snapshots:
        history.take_snapshots(
            spark, snapshots, snapshot_schema, history_schema, date_column, run_date, f"{root}/{snapshot_schema}"
        )
    written = {}

    def write(name: str, df: DataFrame) -> DataFrame:
        written[name] = storage.write_version(df, f"{root}/{name}", run_date)
        return spark.read.parquet(written[name])

    outcomes = write("outcome", suite.run_suite(relations, checks))
    results = write("test_result", suite.test_results(outcomes))
    errors = write("test_error", suite.test_errors(outcomes))
    write("health", health.health_rollup(results))
    write("health_report", health.health_report(results))
    write("error_list", health.error_list(errors))
    if keep_violations:
        tables = {r.name: r.df for r in relations}
        failed = {row.unique_id for row in errors.select("unique_id").collect()}  # one row per failed check
        for check in checks:
            if check.unique_id in failed:
                write(f"violations/{check.unique_id}", check.violations(tables))
    return written
