"""Checks, the fused suite, and the health roll-ups of its outcome."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import checks, health, inventory, suite
from ..session import new_shared_path
from ..sources import run_files, storage
from . import daily_job, run_texts
from .registry import Tables, query

DIRTY = ("customer_dirty",)

CHECK_SQL = {
    "not_null": "select * from customer_dirty where segment is null and c_acctbal > 0",
    "is_null": "select * from customer_dirty where segment is not null and c_acctbal < 0",
    "not_null_or_empty": "select * from customer_dirty where segment is null or segment = ''",
    "equals": "select * from customer_dirty where segment <> 'BUILDING'",
    "is_true": "select * from customer_dirty where not (c_acctbal > 0 and nationkey < 20)",
    "value_range": "select * from customer_dirty where not (c_acctbal between 0 and 2147483647)",
    "accepted_values": """
        select segment as value_field, count(*) as n_records from customer_dirty
        where segment not in ('BUILDING', 'MACHINERY') group by segment""",
    "relationship_defined": """
        select * from customer_dirty where nationkey not in (select n_nationkey from nation)""",
    "relationship_cardinality": """
        select * from orders where o_orderkey not in (
          select l_orderkey from lineitem group by l_orderkey having count(*) between 1 and 4)""",
    "unique_combination": """
        select l_orderkey, l_linenumber from lineitem group by l_orderkey, l_linenumber having count(*) > 1""",
    "daily_variance": """
        with days as (select cast(snap_date as date) as history_date, count(*) as row_count from user_state_history group by 1),
        pairs as (select *, coalesce(lag(row_count) over (order by history_date desc), row_count) as last_row_count from days),
        changes as (select *, cast(abs(row_count * 100 // last_row_count - 100) as bigint) as change_percentage from pairs)
        select * from changes where change_percentage not between 0 and 3""",
    "email_ok": r"""
        with trimmed as (select *, trim(coalesce(email, '')) as trimmed_value from customer_dirty)
        select *, 0 as is_ok from trimmed
        where trimmed_value = '' or contains(trimmed_value, ' ') or regexp_matches(trimmed_value, '["(),:;<>\\]')
          or regexp_matches(substr(trimmed_value, greatest(instr(trimmed_value, '@'), 1)), '[!#$%&*+/=?^`_{|]')
          or regexp_matches(left(trimmed_value, 1), '[-_.+]') or regexp_matches(right(trimmed_value, 1), '[-_.+]')
          or contains(trimmed_value, '[') or contains(trimmed_value, ']') or trimmed_value like '%@%@%'
          or trimmed_value not like '_%@_%._%'""",
    "phone_ok": """
        select distinct * from customer_dirty except
        select c.* from customer_dirty c join country_code k on starts_with(c.phone, k.code)
        where length(c.phone) between 10 and 15 and regexp_matches(c.phone, '^[0-9]+$')""",
    "national_id": """
        with shaped as (select *, coalesce(regexp_matches(national_id, '^[0-9]{10}$'), false) as ok from customer_dirty),
        digits as (
          select * exclude (ok), ok,
            case when ok then cast(substr(national_id, 1, 1) as int) else -1 end as digit_1,
            case when ok then cast(substr(national_id, 2, 1) as int) else -1 end as digit_2,
            case when ok then cast(substr(national_id, 3, 1) as int) else -1 end as digit_3,
            case when ok then cast(substr(national_id, 4, 1) as int) else -1 end as digit_4,
            case when ok then cast(substr(national_id, 5, 1) as int) else -1 end as digit_5,
            case when ok then cast(substr(national_id, 6, 1) as int) else -1 end as digit_6,
            case when ok then cast(substr(national_id, 7, 1) as int) else -1 end as digit_7,
            case when ok then cast(substr(national_id, 8, 1) as int) else -1 end as digit_8,
            case when ok then cast(substr(national_id, 9, 1) as int) else 5000 end as check_digit
          from shaped),
        summed as (
          select *, 3 * digit_1 + 2 * digit_2 + 7 * digit_3 + 6 * digit_4 + 5 * digit_5 + 4 * digit_6 + 3 * digit_7
            + 2 * digit_8 as weighted_sum from digits),
        computed as (
          select *, case when weighted_sum % 11 = 0 then 0 else 11 - weighted_sum % 11 end as computed_digit from summed),
        flagged as (
          select *, cast(national_id is null as int) as null_error,
            cast(national_id is not null and length(national_id) <> 10 as int) as length_error,
            cast(national_id is not null and length(national_id) = 10 and not ok as int) as non_numeric_error,
            cast(ok and digit_1 not in (8, 9) and check_digit <> computed_digit as int) as checksum_error
          from computed)
        select * exclude (ok) from flagged
        where null_error + length_error + non_numeric_error + checksum_error = 1""",
}


@query("chk_not_null", CHECK_SQL["not_null"], DIRTY)
def _(t: Tables):
    return checks.not_null(t.customer_dirty, "segment", "c_acctbal > 0")


@query("chk_is_null", CHECK_SQL["is_null"], DIRTY)
def _(t: Tables):
    return checks.is_null(t.customer_dirty, "segment", "c_acctbal < 0")


@query("chk_not_null_or_empty", CHECK_SQL["not_null_or_empty"], DIRTY)
def _(t: Tables):
    return checks.not_null_or_empty(t.customer_dirty, "segment")


ALWAYS_SQL = """
    select * from (
      select cast(sum(cast({condition} as int)) as bigint) as empty_rows, count(*) as all_rows
      from (select case when c_nationkey = 3 then '' end as remark, case when c_nationkey > 99 then '' end as note from customer) c
    ) n where empty_rows = all_rows"""


def _remarks(t: Tables):
    return t.customer.selectExpr(
        "case when c_nationkey = 3 then '' end as remark", "case when c_nationkey > 99 then '' end as note"
    )


@query("chk_not_always_null", ALWAYS_SQL.format(condition="note is null"))
def _(t: Tables):
    return checks.not_always_null(_remarks(t), "note")


@query("chk_not_always_empty", ALWAYS_SQL.format(condition="remark is null or remark = ''"))
def _(t: Tables):
    return checks.not_always_null_or_empty(_remarks(t), "remark")


@query("chk_equals", CHECK_SQL["equals"], DIRTY)
def _(t: Tables):
    return checks.equals(t.customer_dirty, "segment", "'BUILDING'")


@query("chk_is_true", CHECK_SQL["is_true"], DIRTY)
def _(t: Tables):
    return checks.is_true(t.customer_dirty, "c_acctbal > 0 and nationkey < 20")


@query("chk_value_range", CHECK_SQL["value_range"], DIRTY)
def _(t: Tables):
    return checks.value_range(t.customer_dirty, "c_acctbal")


@query("chk_accepted_values", CHECK_SQL["accepted_values"], DIRTY)
def _(t: Tables):
    return checks.accepted_values(t.customer_dirty, "segment", ["BUILDING", "MACHINERY"])


@query("chk_relationship_defined", CHECK_SQL["relationship_defined"], DIRTY)
def _(t: Tables):
    return checks.relationship_defined(t.customer_dirty, "nationkey", t.nation, "n_nationkey")


@query("chk_relationship_defined_in", CHECK_SQL["relationship_defined"].replace("not in", "in"), DIRTY)
def _(t: Tables):
    return checks.relationship_defined(t.customer_dirty, "nationkey", t.nation, "n_nationkey", existence="")


@query(
    "chk_relationship_null_keys",
    "select * from nation where n_nationkey not in (select nationkey from customer_dirty)",
    DIRTY,
)
def _(t: Tables):
    return checks.relationship_defined(t.nation, "n_nationkey", t.customer_dirty, "nationkey")


@query("chk_relationship_cardinality", CHECK_SQL["relationship_cardinality"])
def _(t: Tables):
    return checks.relationship_cardinality(t.orders, "o_orderkey", t.lineitem, "l_orderkey", 1, 4)


@query("chk_unique_combination", CHECK_SQL["unique_combination"])
def _(t: Tables):
    return checks.unique_combination(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "chk_unique_recent",
    """
    select o_custkey, o_orderstatus from orders
    where o_orderdate > (select cast(max(o_orderdate) as date) - 365 from orders)
    group by o_custkey, o_orderstatus having count(*) > 1""",
)
def _(t: Tables):
    return checks.unique_combination_recent(t.orders, ["o_custkey", "o_orderstatus"], "o_orderdate", 365)


@query("chk_daily_variance", CHECK_SQL["daily_variance"], ("user_state_history",))
def _(t: Tables):
    return checks.daily_cardinality_variance(t.user_state_history, "snap_date", 3)


@query("chk_email_ok", CHECK_SQL["email_ok"], DIRTY)
def _(t: Tables):
    return checks.email_ok(t.customer_dirty, "email")


@query("chk_phone_ok", CHECK_SQL["phone_ok"], ("customer_dirty", "country_code"))
def _(t: Tables):
    return checks.phone_ok(t.customer_dirty, "phone", t.country_code, "code")


@query("chk_national_id", CHECK_SQL["national_id"], DIRTY)
def _(t: Tables):
    return checks.national_id_ok(t.customer_dirty, "national_id")


# The suite: 23 checks on five relations of two databases.


def _suite_relations(t: Tables) -> list[suite.Relation]:
    return [
        suite.Relation("warehouse", "sales", "customer", t.customer_dirty),
        suite.Relation("warehouse", "sales", "orders", t.orders),
        suite.Relation("warehouse", "sales", "lineitem", t.lineitem),
        suite.Relation("warehouse", "reference", "nation", t.nation),
        suite.Relation("warehouse", "reference", "country_code", t.country_code),
        suite.Relation("lake", "logs", "user_state", t.user_state_history),
    ]


SUITE = [
    suite.not_null("customer", "segment", "c_acctbal > 0"),
    suite.is_null("customer", "segment", "c_acctbal < 0"),
    suite.not_null_or_empty("customer", "segment"),
    suite.not_always_null("customer", "email"),
    suite.not_always_null_or_empty("customer", "segment"),
    suite.equals("customer", "segment", "'BUILDING'", severity="warn"),
    suite.is_true("customer", "c_acctbal > 0 and nationkey < 20", severity="warn"),
    suite.value_range("customer", "c_acctbal", severity="warn"),
    suite.email_ok("customer", "email"),
    suite.national_id_ok("customer", "national_id"),
    suite.accepted_values("customer", "segment", ["BUILDING", "MACHINERY"]),
    suite.relationship_defined("customer", "nationkey", "nation", "n_nationkey"),
    suite.phone_ok("customer", "phone", "country_code", "code"),
    suite.unique_combination("customer", ["c_custkey"]),
    suite.not_null("orders", "o_orderkey"),
    suite.value_range("orders", "o_totalprice", 0, 450000, severity="warn"),
    suite.relationship_defined("orders", "o_custkey", "customer", "c_custkey"),
    suite.relationship_cardinality("orders", "o_orderkey", "lineitem", "l_orderkey", 1, 4),
    suite.value_range("lineitem", "l_discount", 0, 1),
    suite.unique_combination("lineitem", ["l_orderkey", "l_linenumber"]),
    suite.not_null("nation", "n_name"),
    suite.not_null("user_state", "event_type"),
    suite.daily_cardinality_variance("user_state", "snap_date", 3),
]

_SUITE_COUNTS = [
    ("customer", "not_null", "segment", "fail", f"({CHECK_SQL['not_null']})"),
    ("customer", "is_null", "segment", "fail", f"({CHECK_SQL['is_null']})"),
    ("customer", "not_null_or_empty", "segment", "fail", f"({CHECK_SQL['not_null_or_empty']})"),
    ("customer", "not_always_null", "email", "fail",
     "(select 1 from customer_dirty having count(email) = 0)"),
    ("customer", "not_always_null_or_empty", "segment", "fail",
     "(select 1 from customer_dirty having count(nullif(segment, '')) = 0)"),
    ("customer", "equals", "segment", "warn", f"({CHECK_SQL['equals']})"),
    ("customer", "is_true", None, "warn", f"({CHECK_SQL['is_true']})"),
    ("customer", "value_range", "c_acctbal", "warn", f"({CHECK_SQL['value_range']})"),
    ("customer", "email_ok", "email", "fail", f"({CHECK_SQL['email_ok']})"),
    ("customer", "national_id_ok", "national_id", "fail", f"({CHECK_SQL['national_id']})"),
    ("customer", "accepted_values", "segment", "fail", f"({CHECK_SQL['accepted_values']})"),
    ("customer", "relationship_defined", "nationkey", "fail", f"({CHECK_SQL['relationship_defined']})"),
    ("customer", "phone_ok", "phone", "fail", f"({CHECK_SQL['phone_ok']})"),
    ("customer", "unique_combination", None, "fail",
     "(select c_custkey from customer_dirty group by c_custkey having count(*) > 1)"),
    ("orders", "not_null", "o_orderkey", "fail", "(select * from orders where o_orderkey is null)"),
    ("orders", "value_range", "o_totalprice", "warn",
     "(select * from orders where o_totalprice not between 0 and 450000)"),
    ("orders", "relationship_defined", "o_custkey", "fail",
     "(select * from orders where o_custkey not in (select c_custkey from customer_dirty))"),
    ("orders", "relationship_cardinality", "o_orderkey", "fail", f"({CHECK_SQL['relationship_cardinality']})"),
    ("lineitem", "value_range", "l_discount", "fail", "(select * from lineitem where l_discount not between 0 and 1)"),
    ("lineitem", "unique_combination", None, "fail", f"({CHECK_SQL['unique_combination']})"),
    ("nation", "not_null", "n_name", "fail", "(select * from nation where n_name is null)"),
    ("user_state", "not_null", "event_type", "fail", "(select * from user_state_history where event_type is null)"),
    ("user_state", "daily_cardinality_variance", "snap_date", "fail", f"({CHECK_SQL['daily_variance']})"),
]

_PLACES = {
    "customer": ("warehouse", "sales", "customer_dirty"),
    "orders": ("warehouse", "sales", "orders"),
    "lineitem": ("warehouse", "sales", "lineitem"),
    "nation": ("warehouse", "reference", "nation"),
    "user_state": ("lake", "logs", "user_state_history"),
}


def _outcome_sql() -> str:
    rows = []
    for relation, test, column, severity, failing in _SUITE_COUNTS:
        database, schema, source = _PLACES[relation]
        unique_id = f"test.{relation}.{test}" + (f".{column}" if column else "")
        rows.append(
            f"select '{database}' as database_name, '{schema}' as schema_name, '{relation}' as relation_name, "
            f"'{test}' as test_name, " + (f"'{column}'" if column else "cast(null as varchar)") + " as column_name, "
            f"'{unique_id}' as unique_id, '{severity}' as severity, "
            f"(select count(*) from {failing} f) as rows_on_error, (select count(*) from {source}) as rows_in_relation"
        )
    union = "\nunion all\n".join(rows)
    return (
        f"with counted as ({union}),\noutcome as (select *, case when rows_on_error = 0 then 'pass' "
        "when severity = 'warn' then 'warn' else 'fail' end as result from counted)\n"
    )


OUTCOME_SQL = _outcome_sql()
SUITE_INPUTS = ("customer_dirty", "country_code", "user_state_history")
SUMS = """cast(sum(cast(result = 'pass' as int)) as bigint) as ok_count,
    cast(sum(cast(result = 'warn' as int)) as bigint) as warning_count,
    cast(sum(cast(result = 'fail' as int)) as bigint) as fail_count"""
SHARES = """ok_count, round(ok_count * 100 / (ok_count + warning_count + fail_count), 2) as ok_percentage,
    warning_count, round(warning_count * 100 / (ok_count + warning_count + fail_count), 2) as warning_percentage,
    fail_count, round(fail_count * 100 / (ok_count + warning_count + fail_count), 2) as fail_percentage,
    ok_count + warning_count + fail_count as total_count"""


def stats_sql(keys: str) -> str:
    grouped = f"{keys}, " if keys else ""
    by = f"group by {keys}" if keys else ""
    return OUTCOME_SQL + f", sums as (select {grouped}{SUMS} from outcome {by}) select {grouped}{SHARES} from sums"


def outcomes(t: Tables):
    return suite.run_suite(_suite_relations(t), SUITE)


@query(
    "suite_results",
    OUTCOME_SQL + "select database_name, schema_name, relation_name, test_name, column_name, unique_id, severity, "
    "rows_on_error, rows_in_relation, result from outcome",
    SUITE_INPUTS,
)
def _(t: Tables):
    return outcomes(t).drop("sql")


@query("health_relation", stats_sql("database_name, schema_name, relation_name"), SUITE_INPUTS)
def _(t: Tables):
    return health.relation_stats(suite.test_results(outcomes(t)))


@query("health_schema", stats_sql("database_name, schema_name"), SUITE_INPUTS)
def _(t: Tables):
    return health.schema_stats(suite.test_results(outcomes(t)))


@query("health_database", stats_sql("database_name"), SUITE_INPUTS)
def _(t: Tables):
    return health.database_stats(suite.test_results(outcomes(t)))


@query("health_overall", stats_sql(""), SUITE_INPUTS)
def _(t: Tables):
    return health.overall_stats(suite.test_results(outcomes(t)))


@query(
    "health_rollup",
    OUTCOME_SQL + f""", sums as (
      select case grouping(database_name) + grouping(schema_name) + grouping(relation_name)
          when 0 then 'relation' when 1 then 'schema' when 2 then 'database' else 'overall' end as level,
        database_name, schema_name, relation_name, {SUMS}
      from outcome group by rollup (database_name, schema_name, relation_name))
    select level, database_name, schema_name, relation_name, {SHARES} from sums""",
    SUITE_INPUTS,
)
def _(t: Tables):
    return health.health_rollup(suite.test_results(outcomes(t)))


@query(
    "health_errors",
    OUTCOME_SQL + """
    select database_name, schema_name, relation_name, test_name, unique_id, unique_id || '.sql' as sql_filename,
      rows_on_error, round(rows_on_error * 100 / rows_in_relation, 4) as error_percentage, rows_in_relation,
      schema_name || '/' || relation_name || '/' || unique_id || '.sql' as query_path
    from outcome where result = 'fail'""",
    SUITE_INPUTS,
)
def _(t: Tables):
    return health.error_list(suite.test_errors(outcomes(t))).drop("sql")


@query("suite_violations", OUTCOME_SQL + "select unique_id, rows_on_error as violation_count from outcome", SUITE_INPUTS)
def _(t: Tables):
    """The violating rows of every check, counted one check at a time: as many as the fused suite reports."""
    tables = {r.name: r.df for r in _suite_relations(t)}
    parts = [
        check.violations(tables).agg(F.count("*").alias("violation_count")).select(
            F.lit(check.unique_id).alias("unique_id"), "violation_count")
        for check in SUITE
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "health_errors_measured",
    OUTCOME_SQL + """, sizes as (select database_name, schema_name, relation_name, max(rows_in_relation) as n from outcome
      where relation_name <> 'orders' group by all)
    select o.database_name, o.schema_name, o.relation_name, test_name, unique_id, unique_id || '.sql' as sql_filename,
      rows_on_error, round(rows_on_error * 100 / n, 4) as error_percentage, coalesce(n, -1) as rows_in_relation,
      o.schema_name || '/' || o.relation_name || '/' || unique_id || '.sql' as query_path
    from outcome o left join sizes s on s.relation_name = o.relation_name where result = 'fail'""",
    SUITE_INPUTS,
)
def _(t: Tables):
    """Row counts measured apart from the checks; those of one relation are not known."""
    relations = {(r.database, r.schema, r.name): r.df for r in _suite_relations(t) if r.name != "orders"}
    sizes = inventory.cardinality(t.spark, relations)
    return health.error_list(suite.test_errors(outcomes(t)), sizes).drop("sql")


@query("daily_run", stats_sql("database_name, schema_name, relation_name"), SUITE_INPUTS)
def _(t: Tables):
    """The whole day as a job; its health dataset is read back from the run's folder."""
    written = daily_job.run_daily(
        t.spark, _suite_relations(t), SUITE, new_shared_path(t.spark, "daily"), date(2024, 2, 1), keep_violations=False
    )
    return t.spark.read.parquet(written["health"]).filter("level = 'relation'").drop("level")


@query(
    "daily_run_violations",
    OUTCOME_SQL + "select unique_id, rows_on_error as violation_count from outcome where result = 'fail'",
    SUITE_INPUTS,
)
def _(t: Tables):
    """The day with its last step: the violating rows of each failed check are written, then counted in their files."""
    written = daily_job.run_daily(t.spark, _suite_relations(t), SUITE, new_shared_path(t.spark, "daily"), date(2024, 2, 1))
    parts = [
        t.spark.read.parquet(path).agg(F.count("*").alias("violation_count")).select(
            F.lit(name.partition("/")[2]).alias("unique_id"), "violation_count")
        for name, path in written.items() if name.startswith("violations/")
    ]
    return reduce(DataFrame.unionByName, parts)


@query("health_nested")
def _(t: Tables):
    return health.health_report(suite.test_results(outcomes(t)))


@query(
    "health_nested_rows",
    OUTCOME_SQL + f""", sums as (select database_name, schema_name, relation_name, {SUMS} from outcome group by all)
    select database_name, schema_name, relation_name, ok_count, warning_count, fail_count,
      cast(sum(ok_count + warning_count + fail_count) over (partition by database_name, schema_name) as bigint) as schema_total,
      cast(sum(ok_count + warning_count + fail_count) over (partition by database_name) as bigint) as database_total
    from sums""",
    SUITE_INPUTS,
)
def _(t: Tables):
    """The nested report unfolded again, one row per relation."""
    report = health.health_report(suite.test_results(outcomes(t)))
    schemas = report.selectExpr("database_name", "summary.total.count as database_total", "explode(schemas) as s")
    relations = schemas.selectExpr(
        "database_name", "database_total", "s.name as schema_name", "s.summary.total.count as schema_total", "explode(s.relations) as r"
    )
    return relations.selectExpr(
        "database_name", "schema_name", "r.name as relation_name", "r.summary.ok.count as ok_count",
        "r.summary.warning.count as warning_count", "r.summary.error.count as fail_count", "schema_total", "database_total",
    )


DOCUMENT_SQL = OUTCOME_SQL + f""", sums as (select database_name, {SUMS} from outcome group by all)
    select 'warden' as api_name, 'statistics' as part, database_name as name, ok_count, fail_count from sums
    union all
    select 'warden', 'error', unique_id, 0, rows_on_error from outcome where result = 'fail'"""


@query("health_document_rows", DOCUMENT_SQL, SUITE_INPUTS)
def _(t: Tables):
    """The document unfolded: a row per database and per failed check."""
    found = outcomes(t)
    header = run_files.check_log_header(run_texts.check_log(t))
    document = health.health_document("warden", suite.test_results(found), suite.test_errors(found), header)
    statistics = document.selectExpr("api_name", "explode(stats.databases) as d").selectExpr(
        "api_name", "'statistics' as part", "d.name", "d.summary.ok.count as ok_count", "d.summary.error.count as fail_count")
    errors = document.selectExpr("api_name", "explode(errors) as e").selectExpr(
        "api_name", "'error' as part", "e.unique_id as name", "0 as ok_count", "e.rows_on_error as fail_count")
    return statistics.unionByName(errors)


@query("health_report_files", DOCUMENT_SQL, SUITE_INPUTS)
def _(t: Tables):
    """The report as files, read back: a row per database and per failed check, with the name from the header. The suite
    runs once; its outcome is written and both parts read that."""
    found = storage.settled(outcomes(t), "outcome")
    header = run_files.check_log_header(run_texts.check_log(t))
    paths = health.write_report(
        "warden", suite.test_results(found), suite.test_errors(found), header, new_shared_path(t.spark, "report"))
    parts = health.read_report(t.spark, paths)
    statistics = parts["statistics"].filter("level = 'database'").selectExpr(
        "'statistics' as part", "database_name as name", "ok_count", "fail_count")
    errors = parts["errors"].selectExpr("'error' as part", "unique_id as name", "0L as ok_count", "rows_on_error as fail_count")
    api_name = parts["header"].select("api_name").scalar()
    return statistics.unionByName(errors).select(api_name.alias("api_name"), "*")


@query("health_document")
def _(t: Tables):
    found = outcomes(t)
    header = run_files.check_log_header(run_texts.check_log(t))
    return health.health_document("warehouse", suite.test_results(found), suite.test_errors(found), header)
