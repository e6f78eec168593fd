"""Data checks. Each returns the violating rows; no rows means the check passed.

The row-level checks are predicates, so a suite can count all of them in one scan of the table (see ``suite``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.common import own_shuffle
from ..functions.persons import (
    computed_check_digit,
    national_id_digits,
    national_id_error,
    national_id_sum,
)

INT_MAX = 2147483647

# Character sets of the e-mail rules.
EMAIL_FORBIDDEN = r'["(),:;<>\\]'
EMAIL_FORBIDDEN_FROM_AT = r"[!#$%&*+/=?^`_{|]"
EMAIL_FORBIDDEN_EDGE = r"^[-_.+]|[-_.+]$"
EMAIL_SHAPE = r"^.+@.+\..+$"

# A number that starts with a known country code, 10 to 15 digits and nothing else.
PHONE_SHAPE = r"^\d{10,15}$"


# Predicates: true marks a violating row.


def null_or_empty(column: str) -> Column:
    value = F.col(column)
    return value.isNull() | (value == "")


def outside(column: str, low=0, high=INT_MAX) -> Column:
    return ~F.col(column).between(low, high)


def bad_email(column: str) -> Column:
    """The trimmed value (NULL read as empty) breaks one of the e-mail rules."""
    value = F.trim(F.coalesce(F.col(column), F.lit("")))
    from_at = F.substr(value, F.greatest(F.instr(value, "@"), F.lit(1)))
    rules = (
        value == "",
        value.contains(" "),
        value.rlike(EMAIL_FORBIDDEN),
        from_at.rlike(EMAIL_FORBIDDEN_FROM_AT),
        value.rlike(EMAIL_FORBIDDEN_EDGE),
        value.rlike(r"[\[\]]"),
        value.rlike("@.*@"),
        ~value.rlike(EMAIL_SHAPE),
    )
    return reduce(lambda a, b: a | b, rules)


def bad_national_id(column: str) -> Column:
    return national_id_error(column).isNotNull()


# Row-level checks.


def not_null(df: DataFrame, column: str, where: str = "true") -> DataFrame:
    return df.filter(F.col(column).isNull() & F.expr(where))


def is_null(df: DataFrame, column: str, where: str = "true") -> DataFrame:
    return df.filter(F.col(column).isNotNull() & F.expr(where))


def not_null_or_empty(df: DataFrame, column: str) -> DataFrame:
    return df.filter(null_or_empty(column))


def equals(df: DataFrame, column: str, predicate: str) -> DataFrame:
    """Rows whose value differs from the expression; a NULL on either side passes."""
    return df.filter(F.col(column) != F.expr(predicate))


def is_true(df: DataFrame, predicate: str = "true") -> DataFrame:
    """Rows where the whole predicate is false (it is taken in parentheses); an unknown result passes."""
    return df.filter(~F.expr(predicate))


def value_range(df: DataFrame, column: str, low=0, high=INT_MAX) -> DataFrame:
    return df.filter(outside(column, low, high))


def email_ok(df: DataFrame, column: str) -> DataFrame:
    return df.filter(bad_email(column)).select(
        "*", F.trim(F.coalesce(F.col(column), F.lit(""))).alias("trimmed_value"), F.lit(0).alias("is_ok")
    )


def national_id_ok(df: DataFrame, column: str) -> DataFrame:
    """Bad ids with their digits, weighted sum, computed check digit and exactly one error flag set."""
    value = F.col(column)
    digits, check = national_id_digits(value)
    error = F.col("_error")
    flags = {"null": "null_error", "length": "length_error", "non_numeric": "non_numeric_error", "checksum": "checksum_error"}
    return (
        df.withColumn("_error", national_id_error(column))
        .filter(error.isNotNull())
        .select(
            *df.columns,
            *[d.alias(f"digit_{i}") for i, d in enumerate(digits, 1)],
            check.alias("check_digit"),
            national_id_sum(value).alias("weighted_sum"),
            computed_check_digit(national_id_sum(value)).alias("computed_digit"),
            *[(error == kind).cast("int").alias(name) for kind, name in flags.items()],
        )
    )


# Whole-table checks: one row of counts when the check fails. An empty table fails.


def _always(df: DataFrame, violating: Column) -> DataFrame:
    counts = df.agg(F.count_if(violating).alias("empty_rows"), F.count("*").alias("all_rows"))
    return counts.filter("empty_rows = all_rows")


def not_always_null(df: DataFrame, column: str) -> DataFrame:
    return _always(df, F.col(column).isNull())


def not_always_null_or_empty(df: DataFrame, column: str) -> DataFrame:
    return _always(df, null_or_empty(column))


# Grouped checks: partial aggregation keeps a hot group to one row per task before the shuffle.


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    unexpected = df.filter(~F.col(column).isin(*values))
    return unexpected.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column groups that occur more than once; NULLs fall in one group."""
    return df.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 1").select(*columns)


def unique_combination_recent(
    df: DataFrame, columns: Sequence[str], date_column: str | None = None, days_back: int = 0
) -> DataFrame:
    """:func:`unique_combination` over the rows of the last days before the newest date; 0 days means all rows."""
    if days_back > 0:
        newest = df.agg(F.max(F.to_date(date_column)).alias("newest"))
        limit = newest.select(F.date_sub("newest", days_back)).scalar()
        df = df.filter(F.col(date_column) > limit)
    return unique_combination(df, columns)


def daily_cardinality_variance(df: DataFrame, date_column: str, ok_to: int, ok_from: int = 0) -> DataFrame:
    """Days whose row count differs from the next later day's by a percentage outside the accepted range.

    The percentage is an integer division. The newest day compares with itself. The ordering window sees one row
    per calendar day, never table rows, so a single task is enough for it.
    """
    from pyspark.sql import Window

    days = df.groupBy(F.to_date(date_column).alias("history_date")).agg(F.count("*").alias("row_count"))
    newest_first = Window.orderBy(F.col("history_date").desc())
    return (
        days.withColumn("last_row_count", F.lag("row_count", 1).over(newest_first))
        .withColumn("last_row_count", F.coalesce("last_row_count", "row_count"))
        .withColumn("change_percentage", F.expr("abs(row_count * 100 div last_row_count - 100)"))
        .filter(~F.col("change_percentage").between(ok_from, ok_to))
    )


def uneven_days(days: Column, ok_to: int, ok_from: int = 0) -> Column:
    """How many days of an array of (day, row count) :func:`daily_cardinality_variance` would return."""
    newest_first = F.sort_array(days, asc=False)

    def uneven(day: Column, i: Column) -> Column:
        later = F.coalesce(F.get(newest_first, i - 1)["n"], day["n"])
        return ~F.abs(F.call_function("div", day["n"] * 100, later) - 100).between(ok_from, ok_to)

    return F.size(F.filter(newest_first, uneven)).cast("bigint")


# Checks against another table.


def not_in(df: DataFrame, column: str, keys: DataFrame, has_null: Column, is_empty: Column) -> DataFrame:
    """``column NOT IN (keys)`` with SQL's NULL rules, as a plain shuffled anti join.

    The null-aware anti join that Spark plans for ``NOT IN`` can only broadcast its keys. Here two scalars decide
    instead: a NULL among the keys empties the result, and a NULL on the left survives only without any key.
    ``keys`` holds the distinct non-null keys as ``_key``.
    """
    alive = ~has_null & (F.col(column).isNotNull() | is_empty)
    return df.filter(alive).join(keys, F.col(column) == F.col("_key"), "left_anti")


def relationship_defined(
    df: DataFrame, column: str, to: DataFrame, to_column: str, existence: str = "NOT"
) -> DataFrame:
    """Rows whose value is not among the target's keys; with ``existence=''`` rows whose value is."""
    key = F.col(to_column)
    keys = to.filter(key.isNotNull()).groupBy(key.alias("_key"), own_shuffle(key)).agg(F.lit(1)).select("_key")
    if existence.upper() != "NOT":
        return df.join(keys, F.col(column) == F.col("_key"), "left_semi")
    rows = F.count("*")
    facts = to.agg(F.struct((rows > F.count(key)).alias("has_null"), (rows == 0).alias("is_empty")).alias("x")).scalar()
    return not_in(df, column, keys, facts["has_null"], facts["is_empty"])


def relationship_cardinality(
    df: DataFrame,
    column: str,
    to: DataFrame,
    to_column: str,
    low: int = 1,
    high: int = 1,
    target_predicate: str = "true",
    existence: str = "NOT",
) -> DataFrame:
    """Rows whose key does not have between ``low`` and ``high`` target rows."""
    key = F.col(to_column)
    # One grouped scan of the target; its NULL group answers for the rows without a key.
    sized = (
        to.filter(target_predicate).groupBy(key.alias("_key"), own_shuffle(key)).agg(F.count("*").alias("_n"))
        .filter(F.col("_n").between(low, high))
    )
    keys = sized.filter(F.col("_key").isNotNull()).select("_key")
    if existence.upper() != "NOT":
        return df.join(keys, F.col(column) == F.col("_key"), "left_semi")
    rows = F.count("*")
    facts = sized.agg(F.struct((rows > F.count("_key")).alias("has_null"), (rows == 0).alias("is_empty")).alias("x")).scalar()
    return not_in(df, column, keys, facts["has_null"], facts["is_empty"])


def coded_values(values: DataFrame, column: str, codes: DataFrame, code_column: str) -> DataFrame:
    """The distinct values of ``column`` that start with one of the codes, as ``_coded``.

    A value is cut at every length that a code has, and the cuts are joined with the codes by equality: no prefix is
    compared with every code, and codes may have any length. A usable number has at most 15 digits, so a value has at
    most 15 cuts. Codes that are not all digits can start no number and are left out.
    """
    code = F.col(code_column).cast("string")
    spread = own_shuffle(code)  # a country whose numbers fill the table is split in the join with its code
    listed = codes.filter(code.rlike(r"^\d{1,15}$")).groupBy(code.alias("_code"), spread).agg(F.lit(1)).select("_code")
    lengths = listed.agg(F.sort_array(F.collect_set(F.length("_code")))).scalar()
    distinct = values.select(F.col(column).cast("string").alias("_coded")).filter(F.col("_coded").isNotNull()).distinct()
    cuts = distinct.select("_coded", F.explode(lengths).alias("_length")).select(
        "_coded", F.expr("left(_coded, _length)").alias("_code")
    )
    found = cuts.join(listed, "_code")
    return found.groupBy("_coded", own_shuffle("_coded")).agg(F.lit(1)).select("_coded")


def phone_ok(df: DataFrame, column: str, codes: DataFrame, code_column: str) -> DataFrame:
    """Distinct rows whose value is not a bare E.164 number with a known country code."""
    value = F.col(column).cast("string")
    good = coded_values(df.filter(value.rlike(PHONE_SHAPE)), column, codes, code_column)
    return df.join(good, value == F.col("_coded"), "left_anti").distinct()
