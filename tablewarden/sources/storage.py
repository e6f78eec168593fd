"""Versioned folders of parquet files: write a version, find the newest one, read it back."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import new_shared_path

RUN_DATE = "run_date"
VERSION_PREFIX = f"{RUN_DATE}="


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    location = hadoop.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def versions(spark: SparkSession, root: str) -> list[date]:
    """Run dates of the completely written versions below ``root``, oldest first (a folder listing, no data)."""
    fs, location = _file_system(spark, root)
    if not fs.exists(location):
        return []
    found = []
    for status in fs.listStatus(location):
        name = status.getPath().getName()
        if not name.startswith(VERSION_PREFIX):
            continue
        done, marker = _file_system(spark, f"{root}/{name}/_SUCCESS")
        if done.exists(marker):
            found.append(date.fromisoformat(name[len(VERSION_PREFIX):]))
    return sorted(found)


def version_path(root: str, run_date: date) -> str:
    return f"{root}/{VERSION_PREFIX}{run_date.isoformat()}"


def newest_before(spark: SparkSession, root: str, run_date: date) -> date | None:
    earlier = [v for v in versions(spark, root) if v < run_date]
    return earlier[-1] if earlier else None


def _schema_path(root: str, run_date: date) -> str:
    return f"{root}/_schemas/{run_date.isoformat()}.json"


def write_version(df: DataFrame, root: str, run_date: date, partition_by: list[str] | None = None) -> str:
    """Write (or rewrite) one version; other versions, also the one being read, stay untouched.

    The schema is written first, beside the versions: a version without rows has no file to read it from.
    """
    fs, location = _file_system(df.sparkSession, _schema_path(root, run_date))
    stream = fs.create(location, True)
    try:
        stream.write(bytearray(df.schema.json().encode()))
    finally:
        stream.close()
    path = version_path(root, run_date)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_version(spark: SparkSession, root: str, run_date: date) -> DataFrame:
    """One version with the schema it was written with; versions without a stored schema tell it themselves."""
    path = version_path(root, run_date)
    fs, location = _file_system(spark, _schema_path(root, run_date))
    if not fs.exists(location):
        return spark.read.parquet(path)
    stored = spark.read.text(_schema_path(root, run_date), wholetext=True).first()[0]
    return spark.read.schema(T.StructType.fromJson(json.loads(stored))).parquet(path)


def _stored_schemas(spark: SparkSession, root: str) -> dict[date, T.StructType]:
    """The schemas stored beside the versions, read in one job; a row per distinct schema comes to the driver."""
    fs, location = _file_system(spark, f"{root}/_schemas")
    if not fs.exists(location):
        return {}
    texts = spark.read.text(f"{root}/_schemas/*.json", wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))
    found = {}
    for row in texts.groupBy("value").agg(F.collect_list("file").alias("files")).collect():
        schema = T.StructType.fromJson(json.loads(row.value))
        found.update((date.fromisoformat(file.removesuffix(".json")), schema) for file in row.files)
    return found


def read_versions(spark: SparkSession, root: str, run_dates: list[date]) -> DataFrame:
    """All rows of the given versions with the date of their run as the last column, ``run_date``.

    Versions whose common columns have the same types are one scan with all their columns, NULL where a version did not
    have one: the plan grows with changes of types, not with versions. The newest version's columns come first.
    """
    stored, groups = _stored_schemas(spark, root), []
    for run_date in sorted(run_dates, reverse=True):
        schema = stored.get(run_date) or spark.read.parquet(version_path(root, run_date)).schema
        if RUN_DATE in schema.names:
            raise ValueError(f"the versions below {root} have a column {RUN_DATE}; rename it")
        types = {field.name: field for field in schema}
        for fields, dates in groups:
            if all(fields[n].dataType == field.dataType for n, field in types.items() if n in fields):
                fields.update((n, field) for n, field in types.items() if n not in fields)
                dates.append(run_date)
                break
        else:
            groups.append((types, [run_date]))
    scans = []
    for fields, dates in groups:
        schema = T.StructType([*fields.values(), T.StructField(RUN_DATE, T.DateType())])
        paths = [version_path(root, run_date) for run_date in dates]
        scan = spark.read.schema(schema).option("basePath", root).parquet(*paths)
        scans.append(scan.select(*fields, RUN_DATE))
    result = scans[0]
    for scan in scans[1:]:
        result = result.unionByName(scan, allowMissingColumns=True)
    return result.select(*[c for c in result.columns if c != RUN_DATE], RUN_DATE)


def settled(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` from files of the shared folder: computed once however often they are read, and not again when
    an executor is lost."""
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
