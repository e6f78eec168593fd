"""History: snapshots, type-2 history, latest state, unified dimensions, backfill."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from ..operators import history
from ..session import new_shared_path
from .registry import Tables, query

HISTORY = ("user_state_history",)
DAY_1, DAY_2 = date(2024, 1, 19), date(2024, 1, 20)
NOW = "2024-02-01 00:00:00"


_tables: dict[tuple[str, str], str] = {}


def _new_table(t: Tables, label: str) -> tuple[str, str]:
    """A table name and folder of its own for every run. The table of the run before, whose result has been read by
    then, leaves the catalog."""
    place = (t.spark.sparkContext.applicationId, label)
    if place in _tables:
        t.spark.sql(f"DROP TABLE IF EXISTS {_tables[place]}")
    _tables[place] = f"{label}_{uuid.uuid4().hex}"
    return _tables[place], new_shared_path(t.spark, label)


@query(
    "snapshot_rerun",
    "select date '2024-01-20' as snap_date, * from customer_dirty",
    ("customer_dirty",),
)
def _(t: Tables):
    table, path = _new_table(t, "snapshot")
    source = t.customer_dirty
    history.snapshot_bootstrap(t.spark, source, table, "snap_date", path)
    for _again in range(2):
        history.snapshot_append(t.spark, source, table, "c_custkey", "snap_date", DAY_2)
    return history.snapshot_read(t.spark, table, "snap_date")


@query(
    "snapshot_evolved_read",
    """select date '2024-01-19' as snap_date, c_custkey, segment, cast(null as int) as c_nationkey from load_1
       union all select date '2024-01-20', c_custkey, segment, c_nationkey from load_2""",
    ("load_1", "load_2"),
)
def _(t: Tables):
    table, path = _new_table(t, "evolved")
    first = t.load_1.drop("c_nationkey")
    history.snapshot_bootstrap(t.spark, first, table, "snap_date", path)
    history.snapshot_append(t.spark, first, table, "c_custkey", "snap_date", DAY_1)
    history.snapshot_evolve(t.spark, t.load_2, table)
    history.snapshot_append(t.spark, t.load_2, table, "c_custkey", "snap_date", DAY_2)
    return history.snapshot_read(t.spark, table, "snap_date")


@query(
    "snapshot_schema",
    """select 'customer' as view_name, date '2024-01-20' as snap_date, count(c_custkey) as row_count from customer
       union all select 'orders', date '2024-01-20', count(o_orderkey) from orders""",
)
def _(t: Tables):
    place = (t.spark.sparkContext.applicationId, "schema")
    if place in _tables:
        for schema in ("history", "snapshot"):
            t.spark.sql(f"DROP SCHEMA IF EXISTS {schema}_{_tables[place]} CASCADE")
    run = _tables[place] = uuid.uuid4().hex
    snapshots, public = f"snapshot_{run}", f"history_{run}"
    sources = {"customer_v1": t.customer, "orders_v12": t.orders}
    history.take_snapshots(t.spark, sources, snapshots, public, "snap_date", DAY_2, new_shared_path(t.spark, "schema"))
    return (
        t.spark.table(f"{public}.customer").groupBy("snap_date").agg(F.count("*").alias("row_count"))
        .select(F.lit("customer").alias("view_name"), "snap_date", "row_count")
        .unionByName(
            t.spark.table(f"{public}.orders").groupBy("snap_date").agg(F.count("*").alias("row_count"))
            .select(F.lit("orders").alias("view_name"), "snap_date", "row_count")
        )
    )


@query(
    "history_view_names",
    r"select name, regexp_replace(name, '^(.+)_v[0-9]+$', '\1', 'i') as view_name from table_name",
    ("table_name",),
)
def _(t: Tables):
    return t.table_name.select("name", history.history_view_name(F.col("name")).alias("view_name"))


SCD2_SQL = """
    with paired as (
      select f.c_custkey as f_key, f.segment as f_segment, f.c_nationkey as f_nation,
        s.c_custkey as s_key, s.segment as s_segment, s.c_nationkey as s_nation,
        f.c_custkey is not null and s.c_custkey is not null and f.segment is not distinct from s.segment
          and f.c_nationkey is not distinct from s.c_nationkey as same
      from load_1 f full join load_2 s on f.c_custkey = s.c_custkey),
    versions as (
      select f_key as c_custkey, f_segment as segment, f_nation as c_nationkey, date '2024-01-19' as valid_from,
        case when not same then date '2024-01-20' end as valid_to, same as is_current
      from paired where f_key is not null
      union all
      select s_key, s_segment, s_nation, date '2024-01-20', cast(null as date), true
      from paired where s_key is not null and not same)
"""


def _two_loads(t: Tables):
    root = new_shared_path(t.spark, "scd2")
    tracked = ["segment", "c_nationkey"]
    history.scd2_run(t.spark, root, t.load_1, "c_custkey", tracked, DAY_1)
    for _again in range(2):
        history.scd2_run(t.spark, root, t.load_2, "c_custkey", tracked, DAY_2)
    return history.scd2_history(t.spark, root)


def _fresh_root(t: Tables) -> str:
    return new_shared_path(t.spark, "scd2")


@query(
    "scd2_empty_load",
    """select c_custkey, segment, cast(d as date) as valid_from, cast(e as date) as valid_to, e is null as is_current
       from load_1, (values ('2024-01-19', '2024-01-20'), ('2024-01-21', null)) v(d, e)""",
    ("load_1",),
)
def _(t: Tables):
    """An empty first load, a full one, one that has lost every key, and the full one again."""
    root = _fresh_root(t)
    source = t.load_1.select("c_custkey", "segment")
    loads = (source.filter("c_custkey is null"), source, source.filter("c_custkey is null"), source)
    for day, load in enumerate(loads, 18):
        history.scd2_run(t.spark, root, load, "c_custkey", ["segment"], date(2024, 1, day))
    return history.scd2_history(t.spark, root).drop("row_hash")


@query(
    "scd2_added_column",
    """with old as (select c_custkey, segment from load_1), new as (
         select c_custkey, segment, case when c_nationkey < 10 then c_nationkey end as c_nationkey from load_1)
       select c_custkey, segment, cast(null as int) as c_nationkey, date '2024-01-19' as valid_from, date '2024-01-20' as valid_to,
         false as is_current from new where c_nationkey is not null
       union all
       select c_custkey, segment, c_nationkey, case when c_nationkey is null then date '2024-01-19' else date '2024-01-20' end, null, true
       from new""",
    ("load_1",),
)
def _(t: Tables):
    root = _fresh_root(t)
    wider = t.load_1.selectExpr("c_custkey", "segment", "case when c_nationkey < 10 then c_nationkey end as c_nationkey")
    history.scd2_run(t.spark, root, wider.drop("c_nationkey"), "c_custkey", ["segment"], DAY_1)
    history.scd2_run(t.spark, root, wider, "c_custkey", ["segment", "c_nationkey"], DAY_2)
    return history.scd2_history(t.spark, root).drop("row_hash")


@query("scd2_two_loads", SCD2_SQL + "select * from versions", ("load_1", "load_2"))
def _(t: Tables):
    return _two_loads(t).drop("row_hash")


@query(
    "scd2_public_projection",
    SCD2_SQL + "select c_custkey, segment as customer_segment, c_nationkey, valid_from as saga_gildir_fra, valid_to from versions",
    ("load_1", "load_2"),
)
def _(t: Tables):
    return history.scd2_public_view(
        _two_loads(t), ["row_hash", "is_current"], {"segment": "customer_segment", "valid_from": "saga_gildir_fra"}
    )


@query(
    "latest_metric",
    "select user_id, event_type, value from user_state_history where snap_date = (select max(snap_date) from user_state_history)",
    HISTORY,
)
def _(t: Tables):
    return history.latest_rows(t.user_state_history, "snap_date")


@query(
    "latest_metric_table",
    "select user_id, event_type, value from user_state_history where snap_date = (select max(snap_date) from user_state_history)",
    HISTORY,
)
def _(t: Tables):
    """The same from a table partitioned by day, whose newest day is found in the catalog."""
    table, path = _new_table(t, "metric")
    source = t.user_state_history
    history.snapshot_bootstrap(t.spark, source.drop("snap_date"), table, "snap_date", path)
    target = t.spark.table(table)
    history.backfill_into(t.spark, history.backfill_missing_days(source, target, "snap_date", partitioned=False), table)
    return history.latest_rows_of(t.spark, table, "snap_date")


UNIFIED_SQL = """
    select snap_date, user_id, event_type, value from (
      select *, row_number() over (partition by user_id order by snap_date desc) as rn from user_state_history) r
    where rn = 1"""


@query("unified_dimension", UNIFIED_SQL, HISTORY)
def _(t: Tables):
    return history.unified_dimension(t.user_state_history, "user_id", "snap_date")


@query("unified_dimension_incr", UNIFIED_SQL, HISTORY)
def _(t: Tables):
    target = history.unified_dimension_incremental(None, t.early_history, "user_id", "snap_date")
    return history.unified_dimension_incremental(target, t.user_state_history, "user_id", "snap_date")


@query("unified_dimension_stored", UNIFIED_SQL, HISTORY)
def _(t: Tables):
    """The dimension as a bucketed table after two loads: the early days, then the rest."""
    table, path = _new_table(t, "dimension")
    history.refresh_dimension_table(t.spark, table, t.early_history, "user_id", "snap_date", path=path)
    history.refresh_dimension_table(t.spark, table, t.user_state_history, "user_id", "snap_date")
    return t.spark.table(table).drop(history.BUCKET)


@query(
    "history_watermark",
    """select date '1900-01-01' as without_target, date '1950-01-01' as with_empty_target, max(snap_date) as with_target
       from early_history""",
    ("early_history",),
)
def _(t: Tables):
    return t.spark.range(1).select(
        history.history_watermark(None, "snap_date").alias("without_target"),
        history.history_watermark(t.early_history.filter("user_id is null"), "snap_date").alias("with_empty_target"),
        history.history_watermark(t.early_history, "snap_date").alias("with_target"),
    )


@query(
    "backfill_before",
    """select * from user_state_history
       where snap_date < (select coalesce(min(snap_date), date '2024-02-02') from late_history)""",
    ("user_state_history", "late_history"),
)
def _(t: Tables):
    return history.backfill_before(t.user_state_history, t.late_history, "snap_date", date(2024, 2, 1))


UNDATED_SQL = "select * from user_state_history where snap_date not in (select snap_date from gappy_history)"
UNDATED = """select nullif(snap_date, date '2024-01-12') as snap_date, user_id, event_type, value from {rows}"""


@query("backfill_null_day", UNDATED_SQL + " and snap_date <> date '2024-01-12'", ("user_state_history", "gappy_history"))
def _(t: Tables):
    """Rows without a day are copied by neither form: each form brings half of the users."""
    source = t.spark.sql(UNDATED, rows=t.user_state_history)
    target = t.gappy_history.unionByName(source.filter("snap_date is null"))
    halves = [
        history.backfill_missing_days(source.filter(f"user_id % 2 = {half}"), target, "snap_date", partitioned=half == 1)
        for half in (0, 1)
    ]
    return halves[0].unionByName(halves[1])


@query(
    "backfill_missing_days",
    """select * from user_state_history
       where snap_date not in (select snap_date from gappy_history)""",
    ("user_state_history", "gappy_history"),
)
def _(t: Tables):
    return history.backfill_missing_days(t.user_state_history, t.gappy_history, "snap_date", partitioned=False)


@query(
    "backfill_log",
    """select 'user_state' as table_name, snap_date as history_date, count(*) as row_count,
         timestamp '2024-02-01 00:00:00' as logged_at
       from user_state_history where snap_date not in (select snap_date from gappy_history) group by snap_date""",
    ("user_state_history", "gappy_history"),
)
def _(t: Tables):
    missing = history.backfill_missing_days(t.user_state_history, t.gappy_history, "snap_date", partitioned=False)
    return history.backfill_log("user_state", missing, "snap_date", F.to_timestamp_ntz(F.lit(NOW)))


@query(
    "backfill_schema",
    """select 'user_state' as table_name, snap_date as history_date, count(*) as row_count,
         timestamp '2024-02-01 00:00:00' as logged_at
       from user_state_history where snap_date not in (select snap_date from gappy_history) group by snap_date
       union all
       select 'early_state', snap_date, count(*), timestamp '2024-02-01 00:00:00' from early_history group by snap_date""",
    ("user_state_history", "gappy_history", "early_history"),
)
def _(t: Tables):
    """Every table that both schemas have is filled up: one lacks days, one is empty; a third is in one schema only."""
    place = (t.spark.sparkContext.applicationId, "backfill")
    if place in _tables:
        for schema in ("old", "new"):
            t.spark.sql(f"DROP SCHEMA IF EXISTS {schema}_{_tables[place]} CASCADE")
    run = _tables[place] = uuid.uuid4().hex
    folder = new_shared_path(t.spark, "backfill")
    held = {
        ("old", "user_state"): t.user_state_history, ("new", "user_state"): t.gappy_history,
        ("old", "early_state"): t.early_history, ("new", "early_state"): t.early_history.filter("user_id is null"),
        ("old", "alone"): t.early_history,
    }
    for schema in ("old", "new"):
        t.spark.sql(f"CREATE SCHEMA {schema}_{run} LOCATION '{folder}/{schema}'")
    for (schema, name), rows in held.items():
        table = f"{schema}_{run}.{name}"
        history.snapshot_bootstrap(t.spark, rows.drop("snap_date"), table, "snap_date", f"{folder}/{schema}/{name}")
        history.backfill_into(t.spark, rows, table)
    log = f"new_{run}.backfill_log"
    history.backfill_schemas(t.spark, f"old_{run}", f"new_{run}", "snap_date", log, F.to_timestamp_ntz(F.lit(NOW)))
    return t.spark.table(log)


@query(
    "history_day_reconcile",
    """with s as (select snap_date, count(*) as n from user_state_history group by 1),
         t as (select snap_date, count(*) as n from partial_history group by 1)
       select coalesce(s.snap_date, t.snap_date) as snap_date, coalesce(s.n, 0) as source_count, coalesce(t.n, 0) as target_count
       from s full join t on s.snap_date = t.snap_date where coalesce(s.n, 0) > coalesce(t.n, 0)""",
    ("user_state_history", "partial_history"),
)
def _(t: Tables):
    return history.history_day_reconcile(t.user_state_history, t.partial_history, "snap_date")


@query(
    "backfill_log_timing",
    """with log as (
         select event_id, event_type, ts, lead(ts) over (partition by event_type order by ts desc, event_id desc) as previous_time
         from events)
       select *, date_diff('second', previous_time, ts) as seconds_since_previous,
         date_diff('second', ts, timestamp '2024-02-01 00:00:00') as seconds_until_now from log""",
)
def _(t: Tables):
    log = t.events.select("event_id", "event_type", "ts")
    return history.backfill_log_timing(log, "event_type", "ts", F.to_timestamp_ntz(F.lit(NOW)), "event_id")


@query(
    "history_rows_per_year",
    """select cast(greatest(extract(year from o_orderdate), 1999) as int) as partition_year, count(*) as row_count
       from orders group by 1""",
)
def _(t: Tables):
    return history.rows_per_year(t.orders, "o_orderdate")


@query(
    "history_by_year",
    "select *, cast(greatest(extract(year from o_orderdate), 1999) as int) as partition_year from orders",
)
def _(t: Tables):
    path = new_shared_path(t.spark, "by-year")
    history.repartition_by_year(t.orders, "o_orderdate", path)
    return t.spark.read.parquet(path)
