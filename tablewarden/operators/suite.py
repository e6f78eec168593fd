"""Running many checks over many tables in as few scans as possible."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from . import checks as C


@dataclass(frozen=True)
class Relation:
    """A table under its published name."""

    database: str
    schema: str
    name: str
    df: DataFrame


@dataclass(frozen=True)
class Groups:
    """What a grouped check needs to know of its groups: their keys, and either which of them fail, as a condition on the
    row count and the keys, or how many fail, as a function of the array of all (day, n)."""

    keys: Callable[[], list[Column]]
    fails: Callable[..., Column] | None = None
    fails_of_days: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class Check:
    """One check of one relation.

    ``predicate`` makes it a row-level check and ``always`` a whole-table one; both are conditions on a row, counted
    in the relation's shared scan. Checks with ``groups`` share a second scan, in which the rows are grouped by all
    their keys. ``rows`` returns the violating rows of grouped checks and of those on other tables.
    """

    relation: str
    test: str
    column: str | None = None
    text: str = ""
    predicate: Callable[[], Column] | None = None
    always: Callable[[], Column] | None = None
    rows: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None
    groups: Groups | None = None
    severity: str = "fail"
    variant: str | None = None

    @property
    def unique_id(self) -> str:
        """Relation, test and column; ``variant`` tells apart two such checks with different parameters."""
        return ".".join(["test", self.relation, self.test, *filter(None, (self.column, self.variant))])

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """The violating rows, for writing out when the check fails."""
        df = tables[self.relation]
        if self.predicate is not None:
            return df.filter(self.predicate())
        if self.always is not None:
            return C._always(df, self.always())
        return self.rows(tables)


def not_null(relation: str, column: str, where: str = "true", **kw) -> Check:
    return Check(relation, "not_null", column, f"{column} IS NULL AND {where}",
                 predicate=lambda: F.col(column).isNull() & F.expr(where), **kw)


def is_null(relation: str, column: str, where: str = "true", **kw) -> Check:
    return Check(relation, "is_null", column, f"{column} IS NOT NULL AND {where}",
                 predicate=lambda: F.col(column).isNotNull() & F.expr(where), **kw)


def not_null_or_empty(relation: str, column: str, **kw) -> Check:
    return Check(relation, "not_null_or_empty", column, f"{column} IS NULL OR {column} = ''",
                 predicate=lambda: C.null_or_empty(column), **kw)


def not_always_null(relation: str, column: str, **kw) -> Check:
    return Check(relation, "not_always_null", column, f"every {column} IS NULL", always=lambda: F.col(column).isNull(), **kw)


def not_always_null_or_empty(relation: str, column: str, **kw) -> Check:
    return Check(relation, "not_always_null_or_empty", column, f"every {column} IS NULL OR {column} = ''",
                 always=lambda: C.null_or_empty(column), **kw)


def equals(relation: str, column: str, predicate: str, **kw) -> Check:
    return Check(relation, "equals", column, f"{column} != {predicate}",
                 predicate=lambda: F.col(column) != F.expr(predicate), **kw)


def is_true(relation: str, predicate: str, **kw) -> Check:
    return Check(relation, "is_true", None, f"NOT ({predicate})", predicate=lambda: ~F.expr(predicate), **kw)


def value_range(relation: str, column: str, low=0, high=C.INT_MAX, **kw) -> Check:
    return Check(relation, "value_range", column, f"{column} NOT BETWEEN {low} AND {high}",
                 predicate=lambda: C.outside(column, low, high), **kw)


def email_ok(relation: str, column: str, **kw) -> Check:
    return Check(relation, "email_ok", column, f"{column} is not an e-mail address", predicate=lambda: C.bad_email(column), **kw)


def national_id_ok(relation: str, column: str, **kw) -> Check:
    return Check(relation, "national_id_ok", column, f"{column} is not a national id",
                 predicate=lambda: C.bad_national_id(column), **kw)


def accepted_values(relation: str, column: str, values, **kw) -> Check:
    listed = ", ".join(f"'{v}'" for v in values)
    return Check(relation, "accepted_values", column, f"{column} NOT IN ({listed})",
                 rows=lambda t: C.accepted_values(t[relation], column, values),
                 groups=Groups(lambda: [F.col(column)], lambda n, key: ~key.isin(*values)), **kw)


def relationship_defined(relation: str, column: str, to: str, to_column: str, existence: str = "NOT", **kw) -> Check:
    return Check(relation, "relationship_defined", column, f"{column} {existence} IN ({to}.{to_column})",
                 rows=lambda t: C.relationship_defined(t[relation], column, t[to], to_column, existence), **kw)


def relationship_cardinality(relation: str, column: str, to: str, to_column: str, low=1, high=1,
                             target_predicate: str = "true", existence: str = "NOT", **kw) -> Check:
    return Check(relation, "relationship_cardinality", column,
                 f"{column} {existence} IN ({to}.{to_column} with {low} to {high} rows where {target_predicate})",
                 rows=lambda t: C.relationship_cardinality(
                     t[relation], column, t[to], to_column, low, high, target_predicate, existence), **kw)


def unique_combination(relation: str, columns, date_column: str | None = None, days_back: int = 0, **kw) -> Check:
    every = Groups(lambda: [F.col(c) for c in columns], lambda n, *keys: n > 1) if days_back <= 0 else None
    return Check(relation, "unique_combination", None, f"more than one row per ({', '.join(columns)})",
                 rows=lambda t: C.unique_combination_recent(t[relation], columns, date_column, days_back),
                 groups=every, **kw)


def daily_cardinality_variance(relation: str, date_column: str, ok_to: int, ok_from: int = 0, **kw) -> Check:
    return Check(relation, "daily_cardinality_variance", date_column, f"daily change outside {ok_from} to {ok_to} %",
                 rows=lambda t: C.daily_cardinality_variance(t[relation], date_column, ok_to, ok_from),
                 groups=Groups(lambda: [F.to_date(date_column)], fails_of_days=lambda days: C.uneven_days(days, ok_to, ok_from)),
                 **kw)


def phone_ok(relation: str, column: str, codes: str, code_column: str, **kw) -> Check:
    return Check(relation, "phone_ok", column, f"{column} is not an E.164 number",
                 rows=lambda t: C.phone_ok(t[relation], column, t[codes], code_column), **kw)


DESCRIPTION_SCHEMA = (
    "_check int, database_name string, schema_name string, relation_name string, test_name string, "
    "column_name string, unique_id string, severity string, sql string"
)


def _grouped_counts(df: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """Failing groups of all checks in one row, a column per number of a check.

    One scan: the rows are grouped by the keys of every check, each row once per check, and summed before the shuffle. An
    array of days has one entry per calendar day.
    """
    keys = {i: [key.alias(f"key_{i}_{j}") for j, key in enumerate(check.groups.keys())] for i, check in checks}
    names = {i: [f"key_{i}_{j}" for j in range(len(columns))] for i, columns in keys.items()}
    every = [name for own in names.values() for name in own]
    rows = df.select(*[column for columns in keys.values() for column in columns])
    grouped = rows.groupingSets([[F.col(name) for name in own] for own in names.values()], *every).agg(
        F.count("*").alias("n"), F.grouping_id().alias("left_out")
    )
    counts, shown = [], []
    for i, check in checks:
        # A bit for each key column that does not belong to the set, the first column's the highest.
        own = F.col("left_out") == sum(1 << (len(every) - 1 - at) for at, name in enumerate(every) if name not in names[i])
        if check.groups.fails is not None:
            counts.append(F.count_if(own & check.groups.fails(F.col("n"), *map(F.col, names[i]))).alias(str(i)))
            shown.append(F.col(f"`{i}`"))
        else:
            day = F.struct(F.col(names[i][0]).alias("day"), "n")
            counts.append(F.collect_list(F.when(own, day)).alias(str(i)))
            shown.append(check.groups.fails_of_days(F.col(f"`{i}`")).alias(str(i)))
    return grouped.agg(*counts).select(*shown)


GROUPED_KEYS = 60  # key columns of one grouped scan: their sets are told apart by the bits of a number


def _shared_scans(checks: list[tuple[int, Check]]) -> list[list[tuple[int, Check]]]:
    """The grouped checks in as few scans as their key columns allow."""
    scans, held = [], GROUPED_KEYS
    for i, check in checks:
        size = len(check.groups.keys())
        if held + size > GROUPED_KEYS:
            scans.append([])
            held = 0
        scans[-1].append((i, check))
        held += size
    return scans


def run_suite(relations: Iterable[Relation], suite: Iterable[Check]) -> DataFrame:
    """One row per check: how many violating rows, out of how many rows in the relation, and the outcome.

    All row-level and whole-table checks of a relation, and its row count, come from one aggregate over one scan
    that reads only the columns the checks name. All checks that group the relation alone come from a second scan. Each
    check against another table adds one plan.
    """
    by_name = {r.name: r for r in relations}
    tables = {name: r.df for name, r in by_name.items()}
    numbered = list(enumerate(suite))
    seen: set[str] = set()
    for _, check in numbered:
        if check.relation not in by_name:
            raise ValueError(f"{check.unique_id} checks a relation that is not given")
        if check.unique_id in seen:
            raise ValueError(f"{check.unique_id} occurs twice: give one of them a variant")
        seen.add(check.unique_id)
    described, counted = [], []
    for name, relation in by_name.items():
        own = [(i, c) for i, c in numbered if c.relation == name]
        if not own:
            continue
        size = -1 - len(counted)  # stands for the relation's row count among the check numbers
        counters = [F.count("*").alias(str(size))]
        for i, check in own:
            if check.predicate is not None:
                counters.append(F.count_if(check.predicate()).alias(str(i)))
            elif check.always is not None:
                counters.append((F.count_if(check.always()) == F.count("*")).cast("bigint").alias(str(i)))
            elif check.groups is None:
                failing = check.rows(tables).agg(F.count("*").alias("rows_on_error"))
                counted.append(failing.select(F.lit(str(i)).alias("_check"), "rows_on_error"))
        counts = relation.df.agg(*counters)
        counted.append(counts.unpivot([], [f"`{c}`" for c in counts.columns], "_check", "rows_on_error"))
        for scan in _shared_scans([(i, c) for i, c in own if c.groups is not None]):
            failing = _grouped_counts(relation.df, scan)
            counted.append(failing.unpivot([], [f"`{c}`" for c in failing.columns], "_check", "rows_on_error"))
        place = (relation.database, relation.schema, relation.name)
        described.append((size, *place, None, None, None, None, None))
        described += [(i, *place, c.test, c.column, c.unique_id, c.severity, c.text) for i, c in own]
    outcomes = reduce(DataFrame.unionByName, counted).withColumn("_check", F.col("_check").cast("int"))
    # One description per check the caller listed: small enough to broadcast by construction.
    descriptions = outcomes.sparkSession.createDataFrame(described, DESCRIPTION_SCHEMA)
    same_relation = Window.partitionBy("database_name", "schema_name", "relation_name")
    row_count = F.max(F.when(F.col("_check") < 0, F.col("rows_on_error"))).over(same_relation)
    result = F.when(F.col("rows_on_error") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return (
        outcomes.join(F.broadcast(descriptions), "_check")
        .withColumn("rows_in_relation", row_count)
        .filter("_check >= 0")
        .withColumn("result", result)
        .drop("_check")
    )


def registered_tests(spark: SparkSession, relations: Iterable[Relation], suite: Iterable[Check]) -> DataFrame:
    """The checks of a suite as the tests that definition health counts, one row per check."""
    places = {r.name: (r.database, r.schema, r.name) for r in relations}
    rows = [(*places[c.relation], c.column) for c in suite]
    return spark.createDataFrame(rows, "database_name string, schema_name string, relation_name string, column_name string")


def test_results(outcomes: DataFrame) -> DataFrame:
    """The check-result table."""
    return outcomes.select("database_name", "schema_name", "relation_name", "test_name", "unique_id", "result")


def test_errors(outcomes: DataFrame) -> DataFrame:
    """The failed-check table."""
    file_name = F.concat("unique_id", F.lit(".sql"))
    return outcomes.filter("result = 'fail'").select(
        "database_name",
        "schema_name",
        "relation_name",
        "test_name",
        "unique_id",
        file_name.alias("sql_filename"),
        "rows_on_error",
        "rows_in_relation",
        F.concat_ws("/", "schema_name", "relation_name", file_name).alias("query_path"),
        "sql",
    )
