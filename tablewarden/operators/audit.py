"""Audit trail of runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.common import own_shuffle, percentage
from ..sources.run_files import manifest_nodes, parse_run_results, read_texts


def audit_invocations(texts: DataFrame) -> DataFrame:
    """One row per run-result document.

    ``texts`` holds ``value`` and what the caller knows about each run: parent_run_id, operation, status, start_time.
    """
    return parse_run_results(texts).select(
        F.col("metadata.invocation_id").alias("id"),
        "parent_run_id",
        "operation",
        "status",
        F.col("elapsed_time").alias("execution_time_in_seconds"),
        F.col("args").alias("parameters"),
        F.col("metadata.dbt_version").alias("version"),
        "start_time",
    )


def audit_actions(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row per action of the runs, with the relation its model writes ('' when the manifest does not say)."""
    named = nodes.filter("node.relation_name is not null").select(
        F.col("node.unique_id").alias("unique_id"),
        F.replace(F.col("node.relation_name"), F.lit('"'), F.lit("")).alias("relation_name"),
    )
    relations = named.groupBy("unique_id", own_shuffle("unique_id")).agg(F.max("relation_name").alias("relation_name")).drop("_spread")
    actions = parse_run_results(texts.select("value")).select(
        F.col("metadata.invocation_id").alias("invocation_id"), F.inline("results")
    )
    return actions.join(relations, "unique_id", "left").select(
        "invocation_id",
        "unique_id",
        F.coalesce("relation_name", F.lit("")).alias("relation_name"),
        "status",
        F.col("execution_time").alias("execution_time_in_seconds"),
        F.coalesce("adapter_response.rows_affected", F.lit(0).cast("bigint")).alias("rows_affected"),
        "thread_id",
    )


def ingest_run_results(
    spark: SparkSession,
    path: str,
    manifest_path: str,
    parent_run_id: str,
    operation: str,
    status: str,
    start_time: datetime,
) -> tuple[DataFrame, DataFrame]:
    """Invocation and action rows of the run-result files below a path, all of one operation of one run."""
    known = {
        "parent_run_id": F.lit(parent_run_id),
        "operation": F.lit(operation),
        "status": F.lit(status),
        "start_time": F.lit(start_time),
    }
    texts = read_texts(spark, path, whole_files=True).withColumns(known)
    nodes = manifest_nodes(read_texts(spark, manifest_path, whole_files=True))
    return audit_invocations(texts), audit_actions(texts, nodes)


def append_audit(df: DataFrame, path: str, start_column: str = "start_time") -> None:
    """Append audit rows, partitioned by the day of the run."""
    df.withColumn("run_day", F.to_date(start_column)).write.mode("append").partitionBy("run_day").parquet(path)


def top_expensive_actions(
    invocations: DataFrame, actions: DataFrame, operation: str, parameters_like: str = "%", n: int = 10
) -> DataFrame:
    """The slowest actions of the latest successful run of an operation, with their share of the run's time."""
    done = invocations.filter(
        (F.col("status") == "success") & (F.col("operation") == operation) & F.col("parameters").like(parameters_like)
    )
    latest = done.agg(
        F.max_by(F.struct("id", "execution_time_in_seconds"), F.struct("start_time", "id")).alias("run")
    ).scalar()
    seconds = F.col("execution_time_in_seconds")
    return (
        actions.filter(F.col("invocation_id") == latest["id"])
        .orderBy(seconds.desc(), "unique_id")
        .limit(n)
        .select(
            "unique_id",
            F.round(seconds, 0).alias("seconds"),
            percentage(seconds, latest["execution_time_in_seconds"], 0).alias("percentage_of_run_time"),
            "status",
        )
    )


def run_time_trend(invocations: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Average seconds of successful runs per operation and day, over the last days before ``as_of``."""
    earliest = as_of - F.make_dt_interval(F.lit(days))
    return (
        invocations.filter("status = 'success'")
        .withColumn("day", F.to_date("start_time"))
        .filter(F.col("day") >= earliest)
        .groupBy("operation", "day")
        .agg(F.round(F.avg("execution_time_in_seconds"), 0).alias("seconds"))
        .select("operation", "seconds", "day")
        .orderBy("operation", F.col("day").desc())
    )
