"""Checks: NULL laws, the fused suite, health roll-ups."""

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import checks, standardise, health, suite


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(1,), (2,), (None,)], "k int")


def keys(spark, *items):
    return spark.createDataFrame([(i,) for i in items], "id int")


def found(df):
    return sorted((r[0] for r in df.collect()), key=lambda v: (v is not None, v))


@pytest.mark.parametrize("items", [(1,), (1, None), (), (None,), (1, 1, 1, 2)])
@pytest.mark.parametrize("existence", ["NOT", ""])
def test_relationship_defined_follows_sql(spark, source, items, existence):
    target = keys(spark, *items)
    expected = spark.sql(f"select * from {{s}} where k {existence} in (select id from {{t}})", s=source, t=target)
    assert found(checks.relationship_defined(source, "k", target, "id", existence)) == found(expected)


@pytest.mark.parametrize("items", [(1, 1, 2), (1, None, None), ()])
def test_relationship_cardinality_follows_sql(spark, source, items):
    target = keys(spark, *items)
    sql = "select * from {s} where k not in (select id from {t} group by id having count(*) between 1 and 1)"
    assert found(checks.relationship_cardinality(source, "k", target, "id")) == found(spark.sql(sql, s=source, t=target))


def test_relationship_does_not_nest_loops(spark, source):
    plan = checks.relationship_defined(source, "k", keys(spark, 1, 2), "id")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_null_rules_of_row_checks(spark):
    df = spark.createDataFrame([(None, None), ("", 5), ("x", -1), ("y", 2**31)], "s string, n bigint")
    assert checks.not_null(df, "s").count() == 1
    assert checks.is_null(df, "s").count() == 3
    assert checks.not_null(df, "s", "n is not null").count() == 0
    assert checks.not_null_or_empty(df, "s").count() == 2
    assert checks.value_range(df, "n").count() == 2
    assert checks.equals(df, "s", "'x'").count() == 2
    assert checks.is_true(df, "n > 0 and s = 'y'").count() == 2
    assert [tuple(r) for r in checks.accepted_values(df, "s", ["x", "y"]).collect()] == [("", 1)]


def test_whole_table_checks_fail_on_empty_tables(spark):
    empty = spark.createDataFrame([], "s string")
    assert checks.not_always_null(empty, "s").count() == 1
    filled = spark.createDataFrame([(None,), ("",)], "s string")
    assert checks.not_always_null(filled, "s").count() == 0
    assert checks.not_always_null_or_empty(filled, "s").count() == 1


def test_unique_combination_groups_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None), (2, "a")], "a int, b string")
    assert [tuple(r) for r in checks.unique_combination(df, ["a", "b"]).collect()] == [(1, None)]


def test_recent_days_only(spark):
    df = spark.sql("select * from values (1, date'2024-01-01'), (1, date'2024-01-01'), (2, date'2024-01-10'), (2, date'2024-01-10') as t(k, d)")
    assert found(checks.unique_combination_recent(df, ["k"], "d", 5)) == [2]
    assert found(checks.unique_combination_recent(df, ["k"])) == [1, 2]


def test_daily_variance_compares_with_the_later_day(spark):
    df = spark.range(250).select(F.when(F.col("id") < 100, F.lit("2024-01-01")).otherwise("2024-01-02").cast("date").alias("d"))
    rows = [tuple(r) for r in checks.daily_cardinality_variance(df, "d", 10).collect()]
    assert [(r[1], r[2], r[3]) for r in rows] == [(100, 150, 34)]


@pytest.mark.parametrize(
    "address,good",
    [
        ("a@b.is", True), (" a@b.is ", True), ("a.b-c@d.e.is", True), ("", False), (None, False), ("a b@c.is", False),
        ("a@@b.is", False), ("a@b@c.is", False), ("ab.is", False), ("-a@b.is", False), ("a@b.is.", False), ("a@bis", False),
        ("@b.is", False), ("a@b$.is", False), ("a$@b.is", True), ("a[@b.is", False), ("a,b@c.is", False), ("a\\b@c.is", False),
    ],
)
def test_email(spark, address, good):
    df = spark.createDataFrame([(address,)], "e string")
    assert checks.email_ok(df, "e").count() == (0 if good else 1)


def test_phone_codes(spark):
    codes = spark.createDataFrame([("354",), ("1",), ("1684",), ("+47",), (None,)], "code string")
    numbers = ["3545551234", "12345678901", "4712345678", "354555123", "3545551234567890", "35455512x4", None, "3545551234"]
    df = spark.createDataFrame([(n,) for n in numbers], "p string")
    bad = found(checks.phone_ok(df, "p", codes, "code"))
    assert bad == [None, "354555123", "3545551234567890", "35455512x4", "4712345678"]


def test_phone_codes_of_any_length(spark):
    codes = spark.createDataFrame([("35455",), ("354551",), ("1",)], "code string")
    numbers = ["3545551234", "3545651234", "3545512345", "15551234567"]
    df = spark.createDataFrame([(n,) for n in numbers], "p string")
    assert found(checks.phone_ok(df, "p", codes, "code")) == ["3545651234"]
    assert checks.phone_ok(df, "p", codes.limit(0), "code").count() == 4
    read = {r.p: r.reason for r in standardise.standardise_phones(df, "p", codes, "code").collect()}
    assert read == {"3545551234": None, "3545651234": "country code", "3545512345": None, "15551234567": None}


def test_national_id_sets_one_flag(spark):
    df = spark.createDataFrame([(None,), ("1",), ("12345x7890",), ("1201743389",), ("1201743399",)], "k string")
    rows = checks.national_id_ok(df, "k").collect()
    assert len(rows) == 4
    assert all(r.null_error + r.length_error + r.non_numeric_error + r.checksum_error == 1 for r in rows)


def test_suite_agrees_with_single_checks(spark):
    from tablewarden.plans.check_queries import SUITE, _suite_relations
    from tablewarden.plans.registry import Tables

    relations = _suite_relations(Tables(spark, "/root/testdata/sf0.001"))
    tables = {r.name: r.df for r in relations}
    counted = {r.unique_id: r.rows_on_error for r in suite.run_suite(relations, SUITE).collect()}
    assert len(counted) == len(SUITE)
    for check in SUITE:
        assert counted[check.unique_id] == check.violations(tables).count(), check.unique_id


def test_row_checks_of_a_relation_share_one_scan(spark):
    from tablewarden.plans.check_queries import SUITE, _suite_relations
    from tablewarden.plans.registry import Tables

    relations = _suite_relations(Tables(spark, "/root/testdata/sf0.001"))
    fused = [c for c in SUITE if c.relation == "customer" and c.rows is None]
    plan = suite.run_suite(relations, fused)._jdf.queryExecution().executedPlan().toString()
    assert len(fused) > 8 and plan.count("FileScan") == 1


def test_suite_covers_columns(spark):
    from tablewarden.operators import definitions

    relation = suite.Relation("d", "s", "r", spark.range(1))
    picked = [suite.not_null("r", "a"), suite.value_range("r", "a"), suite.unique_combination("r", ["a", "b"])]
    tests = suite.registered_tests(spark, [relation], picked)
    assert [tuple(r) for r in definitions.column_test_coverage(tests).collect()] == [("d", "s", "r", "a", 2)]
    assert definitions.relation_test_coverage(tests).first().test_count == 3


def test_checks_of_one_kind_and_column_stay_apart(spark):
    df = spark.range(10).toDF("n")
    with pytest.raises(ValueError, match="variant"):
        suite.run_suite([suite.Relation("d", "s", "r", df)], [suite.value_range("r", "n")] * 2)
    with pytest.raises(ValueError, match="not given"):
        suite.run_suite([suite.Relation("d", "s", "r", df)], [suite.value_range("other", "n")])
    twice = [suite.value_range("r", "n", 0, 4), suite.value_range("r", "n", 0, 7, variant="wide")]
    outcomes = suite.run_suite([suite.Relation("d", "s", "r", df)], twice).collect()
    assert sorted((r.rows_on_error, r.rows_in_relation) for r in outcomes) == [(2, 10), (5, 10)]
    only_grouped = [suite.unique_combination("r", ["n"])]
    row = suite.run_suite([suite.Relation("d", "s", "r", df)], only_grouped).first()
    assert (row.rows_on_error, row.rows_in_relation, row.result) == (0, 10, "pass")


RESULTS = [
    ("d1", "s1", "r1", "pass"), ("d1", "s1", "r1", "fail"), ("d1", "s1", "r2", "warn"), ("d1", "s2", "r1", "pass"),
    ("d2", "s1", "r1", "skipped"), ("d2", "s1", "r1", "error"),
]


@pytest.fixture
def results(spark):
    return spark.createDataFrame(RESULTS, "database_name string, schema_name string, relation_name string, result string")


def test_rollup_levels(results):
    rows = {(r.level, r.database_name, r.schema_name, r.relation_name): r for r in health.health_rollup(results).collect()}
    assert len(rows) == 1 + 2 + 3 + 4
    overall = rows["overall", None, None, None]
    assert (overall.ok_count, overall.warning_count, overall.fail_count, overall.total_count) == (2, 1, 1, 4)
    assert overall.ok_percentage == 50.0
    uncounted = rows["relation", "d2", "s1", "r1"]
    assert uncounted.total_count == 0 and uncounted.ok_percentage is None
    assert health.overall_stats(results).first().total_count == 4
    assert health.schema_stats(results).count() == 3


def test_nested_report(results):
    report = {r.database_name: r for r in health.health_report(results).collect()}
    assert [s.name for s in report["d1"].schemas] == ["s1", "s2"]
    assert [r.name for r in report["d1"].schemas[0].relations] == ["r1", "r2"]
    assert report["d1"].summary.error["count"] == 1


def test_error_list_without_row_count(spark):
    errors = spark.createDataFrame(
        [("d", "s", "r", "t", "u", "f", 5, -1, "q", "x"), ("d", "s", "r", "t2", "u2", "f", 5, 40, "q", "x")],
        "database_name string, schema_name string, relation_name string, test_name string, unique_id string, "
        "sql_filename string, rows_on_error bigint, rows_in_relation bigint, query_path string, sql string",
    )
    assert [r.error_percentage for r in health.error_list(errors).collect()] == [None, 12.5]
    sizes = spark.createDataFrame([("d", "s", "r", 50)], "database_name string, schema_name string, relation_name string, row_count bigint")
    assert [r.error_percentage for r in health.error_list(errors, sizes).collect()] == [10.0, 10.0]


def test_report_files_hold_a_row_per_failed_check(results, spark):
    from tablewarden.session import new_shared_path

    columns = "database_name string, schema_name string, relation_name string, test_name string, unique_id string, " \
        "sql_filename string, rows_on_error bigint, rows_in_relation bigint, query_path string, sql string"
    errors = spark.createDataFrame(
        [("007", "s/1", "r=x", "t", f"u{i}", "f", i, 50 if i else -1, "p", "select\n1") for i in range(40)]
        + [(None, None, None, "t", "lost", None, 1, 0, None, None)], columns)
    header = spark.sql("select * from values ('1.7', '2024-01-01', 'b'), ('1.8', '2024-01-02', 'a') as t(version, executed_at, invocation_id)")
    root = new_shared_path(spark, "report")
    for _ in range(2):
        paths = health.write_report("api", results, errors, header, root)
    parts = health.read_report(spark, paths)
    assert [tuple(r) for r in parts["header"].collect()] == [("api", "1.8", "2024-01-02", "a")]
    rolled = health.health_rollup(results)
    assert sorted(map(str, parts["statistics"].select(*rolled.columns).collect())) == sorted(map(str, rolled.collect()))
    expected = health.error_list(errors)
    assert sorted(map(str, parts["errors"].select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    empty = health.read_report(spark, health.write_report("api", results.limit(0), errors.limit(0), header.limit(0), root))
    assert empty["errors"].count() == 0 and empty["header"].first().version is None


def test_daily_job_is_repeatable(spark):
    from datetime import date

    from tablewarden.operators import history
    from tablewarden.plans.check_queries import SUITE, _suite_relations
    from tablewarden.plans.daily_job import run_daily
    from tablewarden.plans.registry import Tables
    from tablewarden.session import new_shared_path

    tables = Tables(spark, "/root/testdata/sf0.001")
    relations, root = _suite_relations(tables), new_shared_path(spark, "daily")
    picked = [c for c in SUITE if c.relation in ("customer", "nation")]
    for _ in range(2):
        paths = run_daily(
            spark, relations, picked, root, date(2024, 1, 1), {"nation_v1": tables.nation}, "daily_snapshot", "daily_history"
        )
    outcomes = spark.read.parquet(paths["outcome"])
    assert outcomes.count() == len(picked)
    for row in outcomes.filter("result = 'fail'").collect():
        assert spark.read.parquet(paths[f"violations/{row.unique_id}"]).count() == row.rows_on_error
    assert spark.table("daily_history.nation").count() == 25
    assert spark.read.parquet(paths["health"]).filter("level = 'overall'").first().total_count == len(picked)


def test_grouped_checks_share_a_scan(spark):
    import random

    dice = random.Random(6)
    rows = [(dice.randint(1, 30), dice.choice([None, "a", "b", "c"]), dice.choice([None, 1, 2, 3]),
             f"2024-01-{dice.randint(1, 9):02}" if dice.random() < 0.95 else None) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, c string, v int, d string").withColumn("d", F.col("d").cast("date"))
    checks = [
        suite.accepted_values("r", "c", ["a", "b"]), suite.accepted_values("r", "c", ["c"], variant="two"),
        suite.accepted_values("r", "v", [1, 2]), suite.unique_combination("r", ["k"]), suite.unique_combination("r", ["c", "v"], variant="cv"),
        suite.unique_combination("r", ["k", "c", "v", "d"], variant="all"), suite.daily_cardinality_variance("r", "d", 10),
        suite.daily_cardinality_variance("r", "d", 50, 5, variant="narrow"),
    ]
    for frame in (df, df.limit(0), df.filter("k = 1"), df.filter("d is null")):
        outcomes = suite.run_suite([suite.Relation("d", "s", "r", frame)], checks)
        counted = {r.unique_id: r.rows_on_error for r in outcomes.collect()}
        assert counted == {c.unique_id: c.violations({"r": frame}).count() for c in checks}
    plan = suite.run_suite([suite.Relation("d", "s", "r", df)], checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 3 and plan.count("Expand") == 3  # two scans and the list of checks; two unpivots


def test_grouped_checks_with_many_keys_take_more_scans(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "a int, b int")
    checks = [suite.unique_combination("r", ["a", "b"][:1 + i % 2], variant=str(i)) for i in range(50)]
    outcomes = suite.run_suite([suite.Relation("d", "s", "r", df)], checks).collect()
    assert sorted(r.rows_on_error for r in outcomes) == [0] * 25 + [1] * 25
