"""History: snapshots, type-2 history, unified dimensions, backfill."""

import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import history
from tablewarden.session import new_shared_path

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


@pytest.fixture
def table():
    return "t" + uuid.uuid4().hex


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_snapshot_rerun_and_empty_source(spark, table):
    source = spark.sql("select * from values (1, 'a'), (2, null), (null, 'c') as t(id, v)")
    history.snapshot_bootstrap(spark, source, table, "day", new_shared_path(spark, table))
    history.snapshot_append(spark, source, table, "id", "day", D1)
    history.snapshot_append(spark, source, table, "id", "day", D2)
    once = history.snapshot_read(spark, table, "day").collect()
    history.snapshot_append(spark, source, table, "id", "day", D2)
    assert sorted(map(str, once)) == sorted(map(str, history.snapshot_read(spark, table, "day").collect()))
    assert len(once) == 4
    assert spark.table(table).columns == ["id", "v", "day"]
    assert history.snapshot_read(spark, table, "day").columns == ["day", "id", "v"]
    history.snapshot_append(spark, source.limit(0), table, "id", "day", D2)
    assert {r.day for r in history.snapshot_read(spark, table, "day").collect()} == {D1}


def test_snapshot_evolves(spark, table):
    first = spark.sql("select 1 as id, 'a' as v")
    second = spark.sql("select 1 as id, cast(2.5 as decimal(5,2)) as n")
    history.snapshot_bootstrap(spark, first, table, "day", new_shared_path(spark, table))
    history.snapshot_append(spark, first, table, "id", "day", D1)
    assert history.snapshot_evolve(spark, second, table) == ["n"]
    assert history.snapshot_evolve(spark, second, table) == []
    history.snapshot_append(spark, second, table, "id", "day", D2)
    read = {r.day: (r.v, None if r.n is None else float(r.n)) for r in spark.table(table).collect()}
    assert read == {D1: ("a", None), D2: (None, 2.5)}
    with pytest.raises(ValueError, match="unsupported type"):
        history.snapshot_evolve(spark, spark.sql("select 1 as id, array(1) as a"), table)


def test_latest_rows_reads_one_partition(spark, table):
    source = spark.range(3).toDF("id")
    history.snapshot_bootstrap(spark, source, table, "day", new_shared_path(spark, table))
    for day in (D1, D2):
        history.snapshot_append(spark, source, table, "id", "day", day)
    latest = history.latest_rows(spark.table(table), "day")
    assert rows(latest) == [(0,), (1,), (2,)]
    assert "PartitionFilters: [isnotnull(day" in latest._jdf.queryExecution().executedPlan().toString()


def test_latest_rows_of_table(spark, table):
    source = spark.range(3).toDF("id")
    history.snapshot_bootstrap(spark, source, table, "day", new_shared_path(spark, table))
    assert history.newest_day(spark, table, "day") is None
    assert history.latest_rows_of(spark, table, "day").count() == 0
    for day in (D1, D2):
        history.snapshot_append(spark, source, table, "id", "day", day)
    history.snapshot_append(spark, source.limit(0), table, "id", "day", D3)
    assert history.newest_day(spark, table, "day") == D2
    assert rows(history.latest_rows_of(spark, table, "day")) == [(0,), (1,), (2,)]
    assert rows(history.latest_rows(spark.table(table), "day")) == [(0,), (1,), (2,)]


def test_incremental_reads_new_partitions_only(spark, table):
    source = spark.range(3).toDF("id")
    history.snapshot_bootstrap(spark, source, table, "day", new_shared_path(spark, table))
    for day in (D1, D2, D3):
        history.snapshot_append(spark, source, table, "id", "day", day)
    target = history.unified_dimension(spark.table(table).filter(F.col("day") <= D2), "id", "day")
    result = history.unified_dimension_incremental(target, spark.table(table), "id", "day")
    assert {(r.id, r.day) for r in result.collect()} == {(0, D3), (1, D3), (2, D3)}
    filters = [line.split("PartitionFilters")[1] for line in result._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]
    assert any("> coalesce(Subquery" in f for f in filters)


def test_take_snapshots(spark):
    run = uuid.uuid4().hex
    sources = {"person_v1": spark.sql("select 1 as id, 'x' as name"), "plain": spark.sql("select 2 as id")}
    for _ in range(2):
        history.take_snapshots(spark, sources, f"s{run}", f"h{run}", "day", D1, new_shared_path(spark, "schema"))
    assert spark.table(f"h{run}.person").count() == 1
    assert spark.table(f"h{run}.plain").count() == 1


@pytest.mark.parametrize("name,view", [("adili_v2", "adili"), ("adili_V10", "adili"), ("adili_vx", "adili_vx"), ("_v1", "_v1")])
def test_view_names(spark, name, view):
    assert spark.range(1).select(history.history_view_name(name)).first()[0] == view
    assert history.scd2_view_name(name, "_h") == view + "_h"


def load(spark, *items):
    return spark.createDataFrame(list(items), "id int, v string, n int")


def test_scd2_three_loads_with_rerun(spark):
    root = new_shared_path(spark, "scd2")
    loads = [
        (D1, load(spark, (1, "a", 1), (2, "b", 1), (3, None, 1))),
        (D2, load(spark, (1, "a", 1), (2, "c", 1), (4, "d", 1))),
        (D3, load(spark, (1, None, 1), (2, "c", 1), (3, None, 1), (4, "", 1))),
    ]
    for day, source in loads:
        history.scd2_run(spark, root, source, "id", ["v", "n"], day)
        history.scd2_run(spark, root, source, "id", ["v", "n"], day)
    versions = {(r.id, r.v, r.valid_from, r.valid_to, r.is_current) for r in history.scd2_history(spark, root).collect()}
    assert versions == {
        (1, "a", D1, D3, False), (1, None, D3, None, True),
        (2, "b", D1, D2, False), (2, "c", D2, None, True),
        (3, None, D1, D2, False), (3, None, D3, None, True),
        (4, "d", D2, D3, False), (4, "", D3, None, True),
    }
    assert history.scd2_history(spark, root).count() == len(versions)
    assert history.scd2_history(spark, root, as_of=D1).count() == 3


def test_scd2_can_keep_removed_keys(spark):
    first = history.scd2_start(load(spark, (1, "a", 1), (2, "b", 1)), "id", ["v"], D1)
    merged = history.scd2_merge(first, load(spark, (1, "a", 1)), "id", ["v"], D2, close_removed=False)
    assert all(r.is_current for r in merged.collect())


def test_row_hash_separates_values(spark):
    df = spark.sql("select * from values ('a', 'bc'), ('ab', 'c'), (null, ''), ('', null), ('-', '-') as t(x, y)")
    assert df.select(history.row_hash(["x", "y"])).distinct().count() == 5


def test_scd2_view(spark, table):
    spark.sql("select 1 as id, 'h' as row_hash, 2 as valid_from").write.saveAsTable(f"{table}_v3")
    spark.sql(f"create schema p{table}")
    view = history.create_scd2_view(spark, f"{table}_v3", f"p{table}", ["row_hash"], {"valid_from": "gildir_fra"}, "_saga")
    assert view.endswith(f"{table}_saga")
    assert spark.table(view).columns == ["id", "gildir_fra"]


@pytest.fixture
def user_history(spark):
    from tablewarden.plans.inputs import frame

    return frame(spark, "/root/testdata/sf0.001", "user_state_history").persist()


def test_incremental_equals_full_for_every_split(user_history):
    full = rows(history.unified_dimension(user_history, "user_id", "snap_date"))
    for split in (date(2023, 1, 1), date(2024, 1, 5), date(2024, 1, 29), date(2025, 1, 1)):
        early = user_history.filter(F.col("snap_date") <= split)
        target = history.unified_dimension(early, "user_id", "snap_date")
        assert rows(history.unified_dimension_incremental(target, user_history, "user_id", "snap_date")) == full
    assert rows(history.unified_dimension_incremental(None, user_history, "user_id", "snap_date")) == full


def test_unified_dimension_prunes_before_the_shuffle(user_history):
    plan = history.unified_dimension(user_history, "user_id", "snap_date")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_unified_dimension_null_key_and_tie_break(spark):
    df = spark.sql("select * from values (null, date'2024-01-01', 1), (null, date'2024-01-02', 2), (7, date'2024-01-01', 3), (7, date'2024-01-01', 9) as t(k, d, v)")
    assert {(r.k, r.v) for r in history.unified_dimension(df, "k", "d", ["v"]).collect()} == {(None, 2), (7, 9)}


def test_stored_dimension_writes_only_touched_buckets(spark):
    from tablewarden.session import new_shared_path

    df = spark.sql(
        "select explode(sequence(date'2024-01-01', date'2024-01-03')) as d, id as k, id * 10 as v from range(40)").withColumn(
        "v", F.col("v") + F.dayofmonth("d")).filter("d < date'2024-01-03' or k in (3, 5)")
    nulls = spark.sql("select * from values (date'2024-01-01', cast(null as bigint), -1L), (date'2024-01-03', null, -3L) as t(d, k, v)")
    df = df.unionByName(nulls)
    first = df.filter("d <= date'2024-01-02'")
    spark.sql("drop table if exists stored_dimension")
    path = new_shared_path(spark, "dimension")
    load = lambda rows: history.refresh_dimension_table(spark, "stored_dimension", rows, "k", "d", buckets=8, path=path)
    rows = lambda: sorted(str(r) for r in spark.table("stored_dimension").drop(history.BUCKET).collect())
    files = lambda: {p for p, in spark.table("stored_dimension").select(F.col("_metadata.file_path")).distinct().collect()}
    assert load(df.limit(0)) == [] and rows() == []
    load(first)
    assert rows() == sorted(str(r) for r in history.unified_dimension(first, "k", "d").collect())
    before = files()
    touched = load(df)
    expected = history.unified_dimension_incremental(history.unified_dimension(first, "k", "d"), df, "k", "d")
    assert rows() == sorted(str(r) for r in expected.collect())
    assert 0 < len(touched) <= 3 and len(before & files()) == len(before) - len(touched)
    assert load(df) == []
    # A load that broke off after its rows and before its watermark is repeated.
    spark.sql(f"alter table stored_dimension set tblproperties ('{history.WATERMARK_PROPERTY}' = '2024-01-02')")
    assert load(df) == touched and rows() == sorted(str(r) for r in expected.collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        newest = df.withColumn(history.BUCKET, F.lit(0))
        plan = history.merge_dimension(spark.table("stored_dimension"), newest, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_backfill(spark):
    source = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-06')) as day, 1 as x")
    target = source.filter("day in (date'2024-01-02', date'2024-01-04')")
    empty = source.limit(0)
    assert history.backfill_before(source, target, "day", D3).count() == 1
    assert history.backfill_before(source, empty, "day", D3).count() == 3
    assert {r.day.day for r in history.backfill_missing_days(source, target, "day").collect()} == {1, 3, 5, 6}
    assert history.backfill_missing_days(source, empty, "day").count() == 6
    assert {r.day.day for r in history.backfill_missing_days(source, target, "day", partitioned=False).collect()} == {1, 3, 5, 6}
    lacking = history.history_day_reconcile(source, target, "day").collect()
    assert [(r.day.day, r.source_count, r.target_count) for r in lacking] == [(1, 1, 0), (3, 1, 0), (5, 1, 0), (6, 1, 0)]


def test_backfill_reads_missing_partitions_only(spark, table):
    source = spark.range(3).toDF("id")
    history.snapshot_bootstrap(spark, source, table, "day", new_shared_path(spark, table))
    for day in (D1, D2, D3):
        history.snapshot_append(spark, source, table, "id", "day", day)
    target = spark.table(table).filter(F.col("day") != D2)
    missing = history.backfill_missing_days(spark.table(table), target, "day")
    assert missing.count() == 3
    filters = [line for line in missing._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]
    assert any("array_contains" in line.split("PartitionFilters")[1] for line in filters)


@pytest.mark.parametrize("partitioned", [True, False])
def test_rows_without_a_day_are_never_copied(spark, partitioned):
    days = spark.sql("select * from values (1, date'2024-01-01'), (2, null), (3, date'2024-01-03') as t(x, day)")
    target = days.filter("x < 3")
    assert [r.x for r in history.backfill_missing_days(days, target, "day", partitioned).collect()] == [3]


def test_backfill_run_with_a_null_day_in_the_target(spark, table):
    source = spark.sql("select * from values (1, date'2024-01-01'), (2, date'2024-01-02'), (3, null) as t(x, day)")
    history.snapshot_bootstrap(spark, source.select("x"), table, "day", new_shared_path(spark, table))
    history.backfill_into(spark, source.filter("x <> 2"), table)
    history.backfill_run(spark, source, table, "day", f"log_{table}", F.lit(datetime(2024, 2, 1)))
    assert sorted(r.x for r in spark.table(table).collect()) == [1, 2, 3]
    assert [(r.history_date.day, r.row_count) for r in spark.table(f"log_{table}").collect()] == [(2, 1)]


def test_backfill_run_is_repeatable(spark, table):
    source = spark.sql("select id as x, date_add(date'2024-01-01', cast(id % 5 as int)) as day from range(50)")
    history.snapshot_bootstrap(spark, source.select("x"), table, "day", new_shared_path(spark, table))
    history.snapshot_append(spark, source.select("x").filter("x % 5 = 1"), table, "x", "day", D2)
    now = F.lit(datetime(2024, 2, 1))
    for _ in range(2):
        history.backfill_run(spark, source, table, "day", f"log_{table}", now)
    assert rows(spark.table(table)) == rows(source.select("x", "day"))
    assert [(r.history_date.day, r.row_count) for r in spark.table(f"log_{table}").orderBy("history_date").collect()] == [
        (1, 10), (3, 10), (4, 10), (5, 10),
    ]


@pytest.mark.parametrize("rows_per_range", [1_000_000, 100, 10])
def test_log_timing_equals_lead(spark, rows_per_range):
    log = spark.range(500).selectExpr(
        "id", "if(id % 3 = 0, 'hot', if(id % 50 = 1, null, 'cold')) as t",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(pmod(id * 7919, 83) as int)) as x",
    )
    now = F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00"))
    ours = history.backfill_log_timing(log, "t", "x", now, "id", rows_per_range)
    expected = spark.sql("select *, lead(x) over (partition by t order by x desc, id desc) as p from {log}", log=log)
    assert sorted(map(str, ours.select("id", "previous_time").collect())) == sorted(
        map(str, expected.selectExpr("id", "p as previous_time").collect())
    )


def test_watermark(spark):
    df = spark.sql("select date'2024-01-02' as d")
    read = spark.range(1).select(
        history.history_watermark(None, "d").alias("a"), history.history_watermark(df.limit(0), "d").alias("b"),
        history.history_watermark(df, "d").alias("c"),
    ).first()
    assert tuple(read) == (date(1900, 1, 1), date(1950, 1, 1), D2)


def test_year_partitions(spark):
    df = spark.sql("select make_date(1990 + cast(id % 20 as int), 1, 1) as d, id from range(200)")
    path = new_shared_path(spark, "years")
    history.repartition_by_year(df, "d", path)
    written = spark.read.parquet(path)
    assert written.count() == 200
    assert {r[0] for r in written.select("partition_year").distinct().collect()} == set(range(1999, 2010))
    assert history.rows_per_year(df, "d").filter("partition_year = 1999").first().row_count == 100


def test_history_is_one_scan_however_many_runs(spark):
    import re
    from datetime import timedelta

    root = new_shared_path(spark, "scd2-many")
    rows = [(1, "a"), (2, "b"), (3, "c")]
    sizes, expected = [], 0
    for run in range(6):
        source = spark.createDataFrame([(k, f"{v}{run if k == run % 3 + 1 else ''}") for k, v in rows], "k int, v string")
        if run > 3:
            source = source.withColumn("w", F.lit(run).cast("int"))
        tracked = source.columns[1:]
        history.scd2_run(spark, root, source, "k", tracked, date(2024, 1, 1) + timedelta(run))
        found = history.scd2_history(spark, root)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len(re.findall("Relation", plan)))
        assert "Union" not in plan
    assert sizes == [1] * 6
    by_run = found.groupBy("is_current").count().collect()
    assert {r.is_current: r["count"] for r in by_run}[True] == 3
    assert found.filter("not is_current and w is not null").count() > 0


def test_history_over_a_change_of_type(spark):
    root = new_shared_path(spark, "scd2-types")
    history.scd2_run(spark, root, spark.createDataFrame([(1, 5), (2, 6)], "k int, v int"), "k", ["v"], date(2024, 1, 1))
    history.scd2_run(spark, root, spark.createDataFrame([(1, 7)], "k int, v int"), "k", ["v"], date(2024, 1, 2))
    history.scd2_run(spark, root, spark.createDataFrame([(1, 8)], "k int, v bigint"), "k", ["v"], date(2024, 1, 3))
    found = history.scd2_history(spark, root)
    assert dict(found.dtypes)["v"] == "bigint"
    assert sorted((r.k, r.v, r.is_current) for r in found.collect()) == [(1, 5, False), (1, 7, False), (1, 8, True), (2, 6, False)]
