"""Record standardisation: the same rows with standard columns and the reason where a value could not be read."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, keys, persons, phones
from ..functions.common import own_shuffle
from ..functions.distance import edit_distance
from .checks import PHONE_SHAPE, coded_values

# Postal codes of this length are domestic, and the home country.
HOME_POSTAL_LENGTH = 3
HOME_ALPHA2 = "is"


def quarantine(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Rows without and with a reason."""
    return df.filter(F.col(reason).isNull()), df.filter(F.col(reason).isNotNull())


def quarantine_counts(df: DataFrame, reason: str = "reason") -> DataFrame:
    """Rows per reason; good rows count as ``ok``."""
    return df.groupBy(F.coalesce(F.col(reason), F.lit("ok")).alias("reason")).agg(F.count("*").alias("row_count"))


def construct_keys(df: DataFrame, parts: Sequence[str], name: str = "constructed_key") -> DataFrame:
    return df.withColumn(name, keys.construct_key(*parts))


def key_collisions(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Constructed keys that more than one combination of inputs gives, with the number of combinations."""
    combinations = df.select(*parts).distinct()
    return (
        combinations.groupBy(keys.construct_key(*parts).alias("constructed_key"))
        .agg(F.count("*").alias("input_count"))
        .filter("input_count > 1")
    )


def surrogate_keys(df: DataFrame, fields: Sequence[str], name: str = "surrogate_key") -> DataFrame:
    return df.withColumn(name, keys.surrogate_key(*fields))


def standardise_phones(
    df: DataFrame, column: str, codes: DataFrame, code_column: str, country_code: str = phones.DEFAULT_COUNTRY_CODE
) -> DataFrame:
    """E.164 digits, MSISDN, and why the number is not usable: ``missing``, ``shape`` or ``country code``."""
    e164 = F.col("e164")
    with_numbers = df.withColumn("e164", phones.e164_digits(column, country_code)).withColumn(
        "msisdn", phones.msisdn(column, country_code)
    )
    known = coded_values(with_numbers.filter(e164.rlike(PHONE_SHAPE)), "e164", codes, code_column)
    joined = with_numbers.join(known, e164 == F.col("_coded"), "left")
    reason = (
        F.when(e164.isNull(), F.lit("missing"))
        .when(~e164.rlike(PHONE_SHAPE), F.lit("shape"))
        .when(F.col("_coded").isNull(), F.lit("country code"))
    )
    return joined.withColumn("reason", reason).drop("_coded")


def conform_dates(df: DataFrame, column: str, mask: str) -> DataFrame:
    return df.withColumn("conformed_date", dates.conform_date(column, mask)).withColumn(
        "reason", dates.date_reason(column, mask, "conformed_date")
    )


def conform_times(df: DataFrame, column: str, default: str | None = None, separator: str = ":") -> DataFrame:
    read = df.withColumn("_read", dates.read_time(column, separator))
    return (
        read.withColumn("conformed_time", F.coalesce("_read", dates.default_time(default)))
        .withColumn("second_of_day", dates.second_of_day("conformed_time"))
        .withColumn("reason", dates.time_reason(column, "_read"))
        .drop("_read")
    )


def person_attributes(
    df: DataFrame,
    national_id: str,
    as_of: date,
    register_code: str | None = None,
    date_of_death: str | None = None,
) -> DataFrame:
    """Birthday, age (at death, or at ``as_of``), legal age, and the national-id error if any."""
    today = F.lit(as_of)
    at = F.coalesce(F.col(date_of_death), today) if date_of_death else today
    code = F.col(register_code) if register_code else F.lit(None).cast("string")
    return (
        df.withColumn("birthday", persons.birthday(national_id))
        .withColumn("age", persons.age_in_years("birthday", at))
        .withColumn("of_legal_age", persons.of_legal_age(code, "birthday", today))
        .withColumn("reason", persons.national_id_error(national_id))
    )


def split_names(df: DataFrame, column: str) -> DataFrame:
    first, middle, last = persons.name_parts(column)
    return df.withColumns({"first_name": first, "middle_name": middle, "last_name": last})


def house_number_ranges(df: DataFrame, column: str) -> DataFrame:
    """Lowest and highest house number; text without one gets the reason ``missing`` or ``not numeric``."""
    low, high = persons.house_numbers(column)
    reason = F.when(F.col(column).isNull(), F.lit("missing")).when(F.col("house_from").isNull(), F.lit("not numeric"))
    return df.withColumns({"house_from": low, "house_to": high}).withColumn("reason", reason)


def resolve_country(
    people: DataFrame,
    countries: DataFrame,
    postal_code: str,
    community_code: str,
    address: str,
    name: str = "country_id",
) -> DataFrame:
    """Country id: a domestic postal code decides, then characters 3 and 4 of the community code, then the address.

    ``countries``: id, alpha_2_code, name. A code or a name may have several countries, and a country no code; the
    smallest id of a code, and of a name, stands.
    """
    listed = countries.select("id", F.lower("alpha_2_code").alias("_alpha2"), F.lower("name").alias("_name"))
    by_code = listed.groupBy("_alpha2", own_shuffle("_alpha2")).agg(F.min("id").alias("_code_id")).drop("_spread")
    by_name = listed.groupBy("_name", own_shuffle("_name")).agg(F.min("id").alias("_name_id")).drop("_spread")
    home = listed.filter(F.col("_alpha2") == HOME_ALPHA2).agg(F.min("id")).scalar()
    resolved = F.when(F.length(F.rtrim(postal_code)) == HOME_POSTAL_LENGTH, home).otherwise(
        F.coalesce("_code_id", "_name_id")
    )
    return (
        people.join(by_code, F.lower(F.substring(community_code, 3, 2)) == F.col("_alpha2"), "left")
        .join(by_name, F.lower(address) == F.col("_name"), "left")
        .withColumn(name, resolved)
        .drop("_alpha2", "_code_id", "_name", "_name_id")
    )


def fuzzy_match(
    left: DataFrame, left_column: str, right: DataFrame, right_column: str, maximum: int, fold_case: bool = True,
    blocks: Sequence[str] = (),
) -> DataFrame:
    """Pairs of distinct values within ``maximum`` edits, with their distance and how many rows carry each.

    With ``blocks``, columns of both sides, only values of one block are matched, and rows with a NULL in them match
    nothing. Copies of a value are one candidate, however many there are. A value is cut into ``maximum`` + 1 pieces of even
    length. Of two values within the limit one piece of the one stands unchanged in the other, moved by at most
    ``maximum`` characters, so pieces are joined with the other side's texts at those places, for the lengths that
    the other value may have. A value gives some 2 * ``maximum`` rows per piece and length, however long it is. The
    distance is checked on the texts.
    """
    if maximum is None or maximum < 0:
        raise ValueError("matching needs a maximum distance; fuzzy_match_blocked also takes all pairs of a block")
    block = [f"block_{i}" for i in range(len(blocks))]

    def values(df: DataFrame, column: str, prefix: str) -> DataFrame:
        return _distinct_values(df, column, prefix, fold_case, blocks).withColumn("size", F.length(f"{prefix}_value"))

    pieces = maximum + 1

    def cut(size: str, number: str) -> tuple[Column, Column]:
        """Start (from 0) and length of a piece: the longer pieces come last."""
        short = F.expr(f"{size} div {pieces}")
        longer = F.greatest(F.col(number) - (F.lit(pieces) - F.expr(f"{size} % {pieces}")), F.lit(0))
        return F.col(number) * short + longer, short + F.when(
            F.col(number) >= F.lit(pieces) - F.expr(f"{size} % {pieces}"), 1
        ).otherwise(0)

    numbers = F.sequence(F.lit(0), F.lit(maximum))
    start, length = cut("size", "number")
    whole = values(left, left_column, "left").select("*", F.explode(numbers).alias("number")).select(
        *block, "left_value", "left_rows", "size", "number",
        F.xxhash64(F.substr("left_value", start + 1, length)).alias("piece"),
    )
    lengths = F.sequence(F.greatest(F.col("own_size") - maximum, F.lit(0)), F.col("own_size") + maximum)
    other = (
        values(right, right_column, "right").withColumnRenamed("size", "own_size")
        .select("*", F.explode(lengths).alias("size")).select("*", F.explode(numbers).alias("number"))
    )
    first = F.greatest(start - maximum, F.lit(0))
    last = F.least(start + maximum, F.col("own_size") - length)
    shifts = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    moved = other.select(
        *block, "right_value", "right_rows", "size", "number", length.alias("length"), F.explode(shifts).alias("at")
    ).select(
        *block, "right_value", "right_rows", "size", "number",
        F.xxhash64(F.substr("right_value", F.col("at") + 1, F.col("length"))).alias("piece"),
    ).distinct()
    distance = edit_distance("left_value", "right_value", maximum, fold_case=False)
    return (
        whole.join(moved.hint("merge"), [*block, "size", "number", "piece"])
        .select(
            *[F.col(b).alias(name) for b, name in zip(block, blocks)],
            "left_value", "right_value", distance.alias("distance"), "left_rows", "right_rows",
        )
        .filter("distance is not null")
        .distinct()
    )


def _distinct_values(df: DataFrame, column: str, prefix: str, fold_case: bool, blocks: Sequence[str]) -> DataFrame:
    """The values of each block with the number of rows that carry them."""
    value: Column = F.lower(column) if fold_case else F.col(column)
    known = df.dropna(subset=[column, *blocks])
    return known.groupBy(
        *[F.col(b).alias(f"block_{i}") for i, b in enumerate(blocks)], value.alias(f"{prefix}_value")
    ).agg(F.count("*").alias(f"{prefix}_rows"))


def fuzzy_match_blocked(
    left: DataFrame,
    left_column: str,
    right: DataFrame,
    right_column: str,
    blocks: Sequence[str],
    maximum: int | None = None,
    fold_case: bool = True,
    chunk: int = 1000,
) -> DataFrame:
    """Pairs of distinct values of one block with their distance; without a ``maximum`` all pairs of a block.

    With a maximum this is :func:`fuzzy_match` inside blocks. Without one every pair is a result, and a hot block would
    be one task. So a block's values are dealt by hash into chunks of some ``chunk`` values on each side, and every
    pair of chunks is a key of its own: a task compares about ``chunk`` times ``chunk`` values, however the block grows,
    and a value is sent once per chunk of the other side, 1 / ``chunk`` of the pairs that it gives. Rows with a NULL in
    a block column or without a value match nothing.
    """
    if not blocks:
        raise ValueError("name the columns that make a block")
    if maximum is not None:
        return fuzzy_match(left, left_column, right, right_column, maximum, fold_case, blocks)
    block = [f"block_{i}" for i in range(len(blocks))]
    mine = _distinct_values(left, left_column, "left", fold_case, blocks)
    theirs = _distinct_values(right, right_column, "right", fold_case, blocks)

    def chunks(values: DataFrame, name: str) -> DataFrame:
        count = F.ceil(F.count("*") / chunk).cast("int").alias(name)
        return values.groupBy(*block, own_shuffle(*block)).agg(count).drop("_spread")

    cuts = chunks(mine, "left_chunks").join(chunks(theirs, "right_chunks"), block)

    def dealt(values: DataFrame, side: str, other: str) -> DataFrame:
        own = F.pmod(F.xxhash64(f"{side}_value"), F.col(f"{side}_chunks")).cast("int")
        return values.join(cuts, block).select(
            *block, f"{side}_value", f"{side}_rows", own.alias(f"{side}_chunk"),
            F.explode(F.sequence(F.lit(0), F.col(f"{other}_chunks") - 1)).alias(f"{other}_chunk"),
        )

    pairs = dealt(mine, "left", "right").join(dealt(theirs, "right", "left"), [*block, "left_chunk", "right_chunk"])
    return pairs.select(
        *[F.col(b).alias(name) for b, name in zip(block, blocks)], "left_value", "right_value",
        edit_distance("left_value", "right_value", None, fold_case=False).alias("distance"), "left_rows", "right_rows",
    )
