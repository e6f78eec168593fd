"""A third of all rows share one key: results stay whole and adaptive execution splits the key's rows."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import audit, checks, compare

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def strict(spark):
    """Joins shuffle, and small partitions already count as skewed."""
    with contextlib.ExitStack() as stack:
        for key, value in SETTINGS.items():
            before = spark.conf.get(key, None)
            spark.conf.set(key, value)
            stack.callback(spark.conf.set, key, before) if before is not None else stack.callback(spark.conf.unset, key)
        yield spark


@pytest.fixture
def hot(strict):
    return strict.range(0, 90_000, 1, 4).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"))


@pytest.fixture
def even(strict):
    return strict.range(0, 5000, 2).select(F.col("id").alias("e"))


def final_plan(df):
    df._jdf.queryExecution().executedPlan()
    rows = df.collect()
    return len(rows), df._jdf.queryExecution().executedPlan().toString()


def test_not_in(hot, even):
    count, plan = final_plan(checks.relationship_defined(hot, "k", even, "e"))
    assert count == hot.filter("k % 2 = 1").count()
    assert "skew=true" in plan


def test_cardinality(hot, even):
    count, plan = final_plan(checks.relationship_cardinality(hot, "k", even, "e"))
    assert count == hot.filter("k % 2 = 1").count()
    assert "skew=true" in plan


def test_only_in_first(hot, even):
    count, plan = final_plan(compare.only_in_first(hot, even.withColumnRenamed("e", "k"), ["k"]))
    assert count == hot.filter("k % 2 = 1").count()
    assert "skew=true" in plan


def test_audit_actions(hot, strict):
    runs = hot.select(
        F.to_json(
            F.struct(
                F.struct(F.col("id").cast("string").alias("invocation_id")).alias("metadata"),
                F.array(F.struct(F.col("k").cast("string").alias("unique_id"), F.lit(1.0).alias("execution_time"))).alias("results"),
            )
        ).alias("value")
    )
    nodes = strict.range(100).select(
        F.struct(F.col("id").cast("string").alias("unique_id"), F.lit('"a"."b"').alias("relation_name")).alias("node")
    )
    count, plan = final_plan(audit.audit_actions(runs, nodes))
    assert count == 90_000
    assert "skew=true" in plan
