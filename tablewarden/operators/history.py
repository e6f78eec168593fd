"""History of tables: daily snapshots, type-2 history, latest state, unified dimensions, backfill.

Snapshot tables are parquet tables partitioned by the snapshot date, so a day is replaced, pruned or copied as a
whole directory.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..sources import storage

# Where an incremental load starts without a target, and with an empty one.
NO_TARGET_WATERMARK = date(1900, 1, 1)
EMPTY_TARGET_WATERMARK = date(1950, 1, 1)

# Fixed value: a trailing version in a table name, dropped for the view name.
VERSION_SUFFIX = r"(?i)^(.+)_v[0-9]+$"

# Oldest yearly partition; earlier rows share the partition before it.
FIRST_PARTITION_YEAR = 2000

SNAPSHOT_TYPES = (
    T.DateType, T.TimestampType, T.TimestampNTZType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.BooleanType, T.StringType, T.CharType, T.VarcharType, T.DecimalType, T.FloatType, T.DoubleType,
)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _identifier(table: str) -> str:
    return ".".join(_quoted(part) for part in table.split("."))


def _declared(field: T.StructField) -> str:
    return field.metadata.get("__CHAR_VARCHAR_TYPE_STRING") or field.dataType.simpleString()


# Daily snapshots.


def snapshot_bootstrap(
    spark: SparkSession, source: DataFrame, history: str, date_column: str, location: str | None = None
) -> None:
    """Create the empty history table if it is missing: the source's columns, partitioned by the snapshot date."""
    columns = ", ".join(f"{_quoted(f.name)} {_declared(f)}" for f in source.schema.fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_identifier(history)} ({columns}, {_quoted(date_column)} date) "
        f"USING parquet PARTITIONED BY ({_quoted(date_column)}){where}"
    )


def snapshot_evolve(spark: SparkSession, source: DataFrame, history: str) -> list[str]:
    """Add the source columns the history lacks; columns are never dropped, older days read NULL in new ones."""
    known = {c.lower() for c in spark.table(history).columns}
    missing = [f for f in source.schema.fields if f.name.lower() not in known]
    for field in missing:
        if not isinstance(field.dataType, SNAPSHOT_TYPES):
            raise ValueError(f"unsupported type {field.dataType.simpleString()} of {field.name}: add the column by hand")
    if missing:
        added = ", ".join(f"{_quoted(f.name)} {_declared(f)}" for f in missing)
        spark.sql(f"ALTER TABLE {_identifier(history)} ADD COLUMNS ({added})")
    return [f.name for f in missing]


def snapshot_append(
    spark: SparkSession, source: DataFrame, history: str, key: str, date_column: str, run_date: date
) -> None:
    """Replace one day of the history by the source rows whose key is not null.

    A static partition overwrite: running it again for the same day gives the same table, an empty source clears
    the day, and other days are never touched.
    """
    rows = source.filter(F.col(key).isNotNull())
    spark.sql(
        f"INSERT OVERWRITE {_identifier(history)} PARTITION ({_quoted(date_column)} = DATE'{run_date.isoformat()}') "
        "BY NAME SELECT * FROM {rows}",
        rows=rows,
    )


def snapshot_read(spark: SparkSession, history: str, date_column: str) -> DataFrame:
    """The history with the snapshot date in front."""
    df = spark.table(history)
    return df.select(date_column, *[c for c in df.columns if c != date_column])


def history_view_name(table_name: str | Column) -> Column:
    """Table name without a trailing ``_v<digits>``."""
    name = F.lit(table_name) if isinstance(table_name, str) else table_name
    return F.regexp_replace(name, VERSION_SUFFIX, "$1")


def _view_name(table_name: str) -> str:
    import re

    return re.sub(VERSION_SUFFIX, r"\1", table_name)


def take_snapshots(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    snapshot_schema_name: str,
    history_schema_name: str,
    date_column: str,
    run_date: date,
    location: str | None = None,
) -> None:
    """One snapshot run over a schema: create, evolve, add missing views, and take every table's snapshot.

    The run date is fixed by the caller, so a run that passes midnight still writes one day. The first column of
    a source is its key. An existing view is left alone: it may combine several table versions by hand.
    """
    for schema in (snapshot_schema_name, history_schema_name):
        where = f" LOCATION '{location}/{schema}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(schema)}{where}")
    for name, source in sources.items():
        table = f"{snapshot_schema_name}.{name}"
        snapshot_bootstrap(spark, source, table, date_column, f"{location}/{name}" if location else None)
        snapshot_evolve(spark, source, table)
        view = f"{history_schema_name}.{_view_name(name)}"
        if not spark.catalog.tableExists(view):
            spark.sql(f"CREATE VIEW {_identifier(view)} AS SELECT * FROM {_identifier(table)}")
        snapshot_append(spark, source, table, source.columns[0], date_column, run_date)


# Type-2 history.

BOOKKEEPING = ("valid_from", "valid_to", "is_current", "row_hash")
PART = "version_part"


def row_hash(columns: Sequence[str]) -> Column:
    """Hash of the tracked columns in which NULL differs from empty text and neighbours cannot run together."""
    texts = [F.col(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat_ws("|", *parts), 256)


def scd2_start(source: DataFrame, key: str, tracked: Sequence[str], run_date: date) -> DataFrame:
    """The first load: every source row is an open version. Rows without a key cannot be followed and are left out."""
    return source.filter(F.col(key).isNotNull()).select(
        key,
        *tracked,
        F.lit(run_date).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        row_hash(tracked).alias("row_hash"),
    )


def scd2_merge(
    current: DataFrame, source: DataFrame, key: str, tracked: Sequence[str], run_date: date, close_removed: bool = True
) -> DataFrame:
    """Versions that result from loading ``source`` over the open versions ``current``.

    Unchanged keys keep their open version; changed keys give a closed and a new open one; new keys an open one;
    keys gone from the source are closed (or kept open). One full outer join on the key; a key's one or two
    versions are emitted from the joined row, so nothing is shuffled twice. Already closed versions are not needed.
    Rows without a key are left out, as in the snapshots. A tracked column that the open versions lack is NULL in
    them, so it makes a new version only where the source has a value.
    """
    for column in tracked:
        if column not in current.columns:
            current = current.withColumn(column, F.lit(None).cast(source.schema[column].dataType))
    hashed = source.filter(F.col(key).isNotNull()).select(F.struct(key, *tracked).alias("s"), F.col(key).alias("_sk"), row_hash(tracked).alias("_sh"))
    held = current.select(
        F.struct(key, *tracked, "valid_from").alias("c"), F.col(key).alias("_ck"), row_hash(tracked).alias("_ch")
    )
    joined = held.join(hashed, F.col("_ck") == F.col("_sk"), "full_outer")

    def version(row: str, valid_from: Column, valid_to: Column, is_current: bool, digest: Column) -> Column:
        return F.struct(
            *[F.col(f"{row}.{c}").alias(c) for c in (key, *tracked)],
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
            F.lit(is_current).alias("is_current"),
            digest.alias("row_hash"),
        )

    no_date = F.lit(None).cast("date")
    today = F.lit(run_date)
    kept = version("c", F.col("c.valid_from"), no_date, True, F.col("_ch"))
    closed = version("c", F.col("c.valid_from"), today, False, F.col("_ch"))
    opened = version("s", today, no_date, True, F.col("_sh"))
    removed = closed if close_removed else kept
    versions = (
        F.when(F.col("c").isNull(), F.array(opened))
        .when(F.col("s").isNull(), F.array(removed))
        .when(F.col("_ch") == F.col("_sh"), F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    return joined.select(F.inline(versions))


def scd2_run(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    run_date: date,
    close_removed: bool = True,
) -> str:
    """Load one day into the type-2 history below ``root`` and return the written version's path.

    A version folder holds what its run closed and everything open, in separate partitions. The input is always
    the newest complete version before the run date, so a repeated run rewrites the same result and a crash leaves
    the previous version in place.
    """
    previous = storage.newest_before(spark, root, run_date)
    if previous is None:
        result = scd2_start(source, key, tracked, run_date)
    else:
        held = storage.read_version(spark, root, previous).filter(F.col(PART) == "current").drop(PART)
        result = scd2_merge(held, source, key, tracked, run_date, close_removed)
    parts = result.withColumn(PART, F.when(F.col("is_current"), "current").otherwise("closed"))
    return storage.write_version(parts, root, run_date, [PART])


def scd2_history(spark: SparkSession, root: str, as_of: date | None = None) -> DataFrame:
    """All versions: those closed by any run, and the open ones of the newest run. Columns that a run did not have
    are NULL in what it closed."""
    runs = [v for v in storage.versions(spark, root) if as_of is None or v <= as_of]
    if not runs:
        raise ValueError(f"no complete version below {root}")
    rows = storage.read_versions(spark, root, runs)
    # Both conditions are on partitions: the open part of older runs is not read.
    held = rows.filter((F.col(PART) == "closed") | (F.col(storage.RUN_DATE) == F.lit(runs[-1])))
    return held.drop(PART, storage.RUN_DATE)


def scd2_public_view(
    history: DataFrame, ignore: Sequence[str] = (), rename: Mapping[str, str] | None = None
) -> DataFrame:
    """The history without the ignored columns and with the renamed ones."""
    rename = rename or {}
    return history.select(*[F.col(c).alias(rename.get(c, c)) for c in history.columns if c not in ignore])


def scd2_view_name(table_name: str, postfix: str = "") -> str:
    """Name of the public view: the table name without version, plus a postfix (none when not configured)."""
    return _view_name(table_name) + postfix


def create_scd2_view(
    spark: SparkSession,
    table: str,
    public_schema: str,
    ignore: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    postfix: str = "",
) -> str:
    """Create or replace the public view over a catalog table."""
    rename = rename or {}
    shown = [c for c in spark.table(table).columns if c not in ignore]
    view = f"{public_schema}.{scd2_view_name(table.split('.')[-1], postfix)}"
    names = ", ".join(_quoted(rename.get(c, c)) for c in shown)
    picked = ", ".join(_quoted(c) for c in shown)
    spark.sql(f"CREATE OR REPLACE VIEW {_identifier(view)} ({names}) AS SELECT {picked} FROM {_identifier(table)}")
    return view


# Latest state and unified dimensions.


def partition_days(spark: SparkSession, table: str, date_column: str) -> list[date]:
    """The days a history table has partitions for, oldest first, from the catalog: no file is opened."""
    marker = f"{date_column}="
    named = [part for row in spark.sql(f"SHOW PARTITIONS {_identifier(table)}").collect() for part in row[0].split("/")]
    days = {part[len(marker):] for part in named if part.startswith(marker)}
    return sorted(date.fromisoformat(day) for day in days if not day.startswith("__"))


def newest_day(spark: SparkSession, table: str, date_column: str) -> date | None:
    """The newest day with rows. A day cleared by an empty source keeps an empty partition and is passed over."""
    for day in reversed(partition_days(spark, table, date_column)):
        if not spark.table(table).filter(F.col(date_column) == F.lit(day)).isEmpty():
            return day
    return None


def latest_rows_of(spark: SparkSession, table: str, date_column: str) -> DataFrame:
    """:func:`latest_rows` of a history table. The day comes from the catalog, so only its own files are opened."""
    day = F.lit(newest_day(spark, table, date_column)).cast("date")
    return spark.table(table).filter(F.col(date_column) == day).drop(date_column)


def latest_rows(history: DataFrame, date_column: str) -> DataFrame:
    """Rows of the newest date without the date column; on a partitioned history only that partition's data is read.

    Finding the date opens every file of the history; for a history table use :func:`latest_rows_of`.
    """
    newest = history.agg(F.max(date_column)).scalar()
    return history.filter(F.col(date_column) == newest).drop(date_column)


def unified_dimension(
    history: DataFrame, key: str, date_column: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The most recent row per key over all days, keys that disappeared included; NULL keys form one group.

    Rank 1 is the only rank kept, so Spark drops all but one row per key and task before the shuffle and a hot
    key stays cheap. Among rows of one key and date the tie-break columns, descending, decide.
    """
    newest = Window.partitionBy(key).orderBy(F.col(date_column).desc(), *[F.col(c).desc() for c in tie_break])
    return history.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def history_watermark(target: DataFrame | None, date_column: str) -> Column:
    """Newest date already in the target, as a scalar; fixed early dates without a target or rows."""
    if target is None:
        return F.lit(NO_TARGET_WATERMARK)
    return F.coalesce(target.agg(F.max(date_column)).scalar(), F.lit(EMPTY_TARGET_WATERMARK))


def unified_dimension_incremental(
    target: DataFrame | None, history: DataFrame, key: str, date_column: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The unified dimension after the days beyond the target's watermark.

    Only newer partitions of the history are read, once: target and newer days go through one window. Write the result to a new version, never over the target.
    """
    newer = history.filter(F.col(date_column) > history_watermark(target, date_column))
    if target is None:
        return unified_dimension(newer, key, date_column, tie_break)
    # A NULL key never equals itself, as in the NOT EXISTS this stands for: such rows of the target stay as they are.
    keyed = target.filter(F.col(key).isNotNull()).unionByName(newer)
    return target.filter(F.col(key).isNull()).unionByName(unified_dimension(keyed, key, date_column, tie_break))


# The unified dimension as a bucketed table: a load moves only what is new and writes only the buckets it changes.

BUCKET = "_bucket"
BUCKETS_PROPERTY, WATERMARK_PROPERTY = "dimension.buckets", "dimension.watermark"


def _table_property(spark: SparkSession, table: str, name: str) -> str | None:
    found = spark.sql(f"show tblproperties {_identifier(table)}").filter(F.col("key") == name).first()
    return found.value if found else None


def _set_property(spark: SparkSession, table: str, name: str, value: str) -> None:
    spark.sql(f"alter table {_identifier(table)} set tblproperties ('{name}' = '{value}')")


def refresh_dimension_table(
    spark: SparkSession, table: str, history: DataFrame, key: str, date_column: str, tie_break: Sequence[str] = (),
    buckets: int | None = None, path: str | None = None,
) -> list[int]:
    """Bring the stored unified dimension up to date with the days of ``history`` beyond its watermark; returns the
    buckets that were written.

    The table is bucketed by the key and has a folder per bucket, so the merge reads the touched buckets as they lie:
    newest rows of the new days, one per key, are shuffled to them, and the table's side has no exchange. Other folders
    are neither read nor written. The watermark is a property of the table, set after the rows: a load that broke off
    is repeated as a whole and gives the same rows. Rows without a key stay beside those of later loads, since NULL
    never equals itself; those beyond the watermark are of a load that broke off and are replaced.

    ``buckets`` counts for the first load only. It should be at least ``spark.sql.shuffle.partitions``, which is the
    default: where buckets are fewer, Spark may shuffle both sides. ``path`` is the folder of a first load, if not the
    warehouse's own. The columns of the first load stay those of the table.
    """
    if not spark.catalog.tableExists(table):
        empty = history.limit(0).withColumn(BUCKET, F.lit(0))
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = empty.write.format("parquet").partitionBy(BUCKET).bucketBy(buckets, key)
        (writer.option("path", path) if path else writer).saveAsTable(table)
        _set_property(spark, table, BUCKETS_PROPERTY, str(buckets))
    buckets = int(_table_property(spark, table, BUCKETS_PROPERTY) or buckets)
    watermark = F.lit(_table_property(spark, table, WATERMARK_PROPERTY) or NO_TARGET_WATERMARK.isoformat()).cast("date")
    newer = unified_dimension(history.filter(F.col(date_column) > watermark), key, date_column, tie_break)
    bucket = F.pmod(F.hash(F.col(key)), F.lit(buckets)).alias(BUCKET)
    newest = storage.settled(newer.select("*", bucket), "newest")
    seen = newest.agg(F.max(date_column).cast("string").alias("day"), F.collect_set(BUCKET).alias("touched")).first()
    touched = sorted(seen.touched)  # at most one number per bucket
    if touched:
        stored = spark.table(table).filter(F.col(BUCKET).isin(touched))
        settled = stored.filter(F.col(key).isNotNull() | (F.col(date_column) <= watermark))
        with _session_setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            merge_dimension(settled, newest, key).write.insertInto(table, overwrite=True)
        _set_property(spark, table, WATERMARK_PROPERTY, seen.day)
    return touched


def merge_dimension(target: DataFrame, newest: DataFrame, key: str) -> DataFrame:
    """The target's rows, replaced by the newer row of the same key where there is one, and the rows of new keys."""
    row = F.struct(*target.columns)
    old = target.select(F.col(key).alias("_key"), row.alias("_old"))
    new = newest.select(F.col(key).alias("_new_key"), row.alias("_new"))
    joined = old.join(new, F.col("_key") == F.col("_new_key"), "full_outer")
    return joined.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")


# Backfill.


def backfill_before(source: DataFrame, target: DataFrame, date_column: str, today: date) -> DataFrame:
    """Source rows older than the target's first day; all rows up to today when the target is empty."""
    first = F.coalesce(target.agg(F.min(date_column)).scalar(), F.date_add(F.lit(today), 1))
    return source.filter(F.col(date_column) < first)


def backfill_missing_days(
    source: DataFrame, target: DataFrame, date_column: str, partitioned: bool = True
) -> DataFrame:
    """Source rows of the days the target lacks, in the target's columns.

    On a source partitioned by the date the target's days arrive as a scalar list and select whole partitions, so
    days the target has are never read. On any other source they are a broadcast hash table. Either way there is
    one element per calendar day. Rows without a day are of no missing day and are never copied.
    """
    days = target.select(F.to_date(date_column).alias("_day")).distinct()
    if partitioned:
        present = days.agg(F.collect_set("_day")).scalar()  # leaves out NULL
        missing = source.filter(~F.array_contains(present, F.col(date_column)))
    else:
        dated = source.filter(F.col(date_column).isNotNull())
        missing = dated.join(F.broadcast(days), F.col(date_column) == F.col("_day"), "left_anti")
    return missing.select(*target.columns)


def backfill_log(table: str, added: DataFrame, date_column: str, logged_at: Column) -> DataFrame:
    """One log row per added day."""
    return added.groupBy(F.col(date_column).alias("history_date")).agg(F.count("*").alias("row_count")).select(
        F.lit(table).alias("table_name"), "history_date", "row_count", logged_at.alias("logged_at")
    )


@contextmanager
def _session_setting(spark: SparkSession, key: str, value: str):
    """A setting for the duration of one statement; inserts into catalog tables take this one from nowhere else."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def backfill_into(spark: SparkSession, rows: DataFrame, table: str) -> None:
    """Write whole days into a history table; days not among the rows stay as they are."""
    with _session_setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def backfill_run(
    spark: SparkSession, source: DataFrame, target: str, date_column: str, log: str, logged_at: Column,
    logged_name: str | None = None,
) -> None:
    """Add the missing days to a catalog table and log them, without touching the days it has.

    The days present are fixed first, from the catalog's partitions: no row is read for them, and rows without a day,
    on either side, play no part. All missing days are written by
    one dynamic partition overwrite, so a repeated run after a crash replaces what the first one left. The log is
    counted from the written table and cannot disagree with it.
    """
    present = partition_days(spark, target, date_column)
    day = F.col(date_column)
    is_new = day.isNotNull() & ~day.isin(present) if present else day.isNotNull()
    backfill_into(spark, source.filter(is_new), target)
    added = spark.table(target).filter(is_new)
    backfill_log(logged_name or target, added, date_column, logged_at).write.mode("append").saveAsTable(log)


def backfill_schemas(
    spark: SparkSession, source_schema: str, target_schema: str, date_column: str, log: str, logged_at: Column
) -> list[str]:
    """:func:`backfill_run` for every table that both schemas have; returns the names. The log names the table only."""
    def names(schema: str) -> set[str]:
        return {row["tableName"] for row in spark.sql(f"SHOW TABLES IN {_identifier(schema)}").collect()}

    paired = sorted(names(source_schema) & names(target_schema))
    for name in paired:
        source, target = spark.table(f"{source_schema}.{name}"), f"{target_schema}.{name}"
        backfill_run(spark, source, target, date_column, log, logged_at, name)
    return paired


def history_day_reconcile(source: DataFrame, target: DataFrame, date_column: str) -> DataFrame:
    """Days with more rows in the source than in the target, ordered by day."""
    left = source.groupBy(F.col(date_column).alias("day")).agg(F.count("*").alias("source_count"))
    right = target.groupBy(F.col(date_column).alias("day")).agg(F.count("*").alias("target_count"))
    counted = left.join(right, "day", "full_outer").select(
        F.col("day").alias(date_column),
        F.coalesce("source_count", F.lit(0)).alias("source_count"),
        F.coalesce("target_count", F.lit(0)).alias("target_count"),
    )
    return counted.filter("source_count > target_count").orderBy(date_column)


def _bounds_below(bounds: str, value: str, size: int) -> Column:
    """How many of the sorted ``bounds``, ``size`` at most, are less than the value: by halving, so a row takes as many
    comparisons as the size has binary digits."""
    strides = F.array(*[F.lit(1 << k) for k in reversed(range(size.bit_length()))])

    def further(below: Column, stride: Column) -> Column:
        return F.when(F.get(bounds, below + stride - 1) < F.col(value), below + stride).otherwise(below)

    return F.aggregate(strides, F.lit(0), further)


def backfill_log_timing(
    log: DataFrame, table_column: str, time_column: str, now: Column, tie_break: str, rows_per_range: int = 1_000_000
) -> DataFrame:
    """Per log row: the table's previous log time, seconds since it, and seconds from the row to ``now``.

    A table may own most of the log, so a table's times are not sorted in one task. Times are cut into ranges at
    approximate quantiles of the whole log, as many as its size asks for, which bounds every range whatever table its
    rows belong to. Neighbours
    are found inside a table's range; a range's first time takes the last time of the table's nearest earlier
    range. Equal times of a table are one entry meanwhile: the lowest ``tie_break`` among them gets the earlier
    time, the others the same time.
    """
    t, x = table_column, time_column
    cuts = max(2, -(-log.count() // rows_per_range))
    shares = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
    bounds = log.agg(F.percentile_approx(x, shares, max(10_000, 10 * cuts))).scalar()
    table = F.struct(t)  # unlike a bare NULL, a struct holding NULL equals itself in a join
    times = log.filter(F.col(x).isNotNull()).groupBy(table.alias("_t"), F.col(x).alias("_x")).agg(F.min(tie_break).alias("_first"))
    ranged = times.withColumn("_bounds", bounds).select("_t", "_x", "_first", _bounds_below("_bounds", "_x", cuts).alias("_range"))
    near = ranged.withColumn("_near", F.lag("_x").over(Window.partitionBy("_t", "_range").orderBy("_x")))
    # At most ``cuts`` rows per table.
    ends = ranged.groupBy("_t", "_range").agg(F.max("_x").alias("_end"))
    earlier = ends.withColumn("_far", F.lag("_end").over(Window.partitionBy("_t").orderBy("_range"))).drop("_end")
    previous = near.join(earlier, ["_t", "_range"]).select("_t", "_x", "_first", F.coalesce("_near", "_far").alias("_prev"))
    joined = log.join(previous, (table == F.col("_t")) & (F.col(x) == F.col("_x")), "left")

    def whole_seconds(time: Column) -> Column:
        micros = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), time.cast("timestamp_ntz"))
        return F.floor(micros / 1_000_000)

    last = F.when(F.col(tie_break) == F.col("_first"), F.col("_prev")).otherwise(F.col(x))
    return (
        joined.withColumn("previous_time", last)
        .withColumn("seconds_since_previous", whole_seconds(F.col(x)) - whole_seconds(F.col("previous_time")))
        .withColumn("seconds_until_now", whole_seconds(now) - whole_seconds(F.col(x)))
        .drop("_t", "_x", "_first", "_prev")
    )


# Yearly partitions.


def partition_year(date_column: str) -> Column:
    """Year of the date; everything before the first partitioned year shares the year before it."""
    return F.greatest(F.year(date_column), F.lit(FIRST_PARTITION_YEAR - 1))


def rows_per_year(history: DataFrame, date_column: str) -> DataFrame:
    return history.groupBy(partition_year(date_column).alias("partition_year")).agg(F.count("*").alias("row_count"))


def repartition_by_year(history: DataFrame, date_column: str, path: str) -> None:
    """Rewrite the history with one directory per year; a rebalance gives a large year several even files."""
    yearly = history.withColumn("partition_year", partition_year(date_column))
    yearly.hint("rebalance", "partition_year").write.mode("overwrite").partitionBy("partition_year").parquet(path)
