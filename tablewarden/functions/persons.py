"""Person attributes: national id, birthday, age, name parts, house numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .common import as_column

DAYS_PER_YEAR = 365.2425
ADULT_AGE = 18

# Register codes that mean "not of legal age".
MINOR_CODES = ("3", "4", "8")

# Weights of the first eight digits of a national id.
NATIONAL_ID_WEIGHTS = (3, 2, 7, 6, 5, 4, 3, 2)

# The last digit of a national id names the century.
CENTURY_BY_LAST_DIGIT = {"8": "18", "9": "19", "0": "20"}

# Characters in a house number that count as blanks.
HOUSE_BLANKS = "aábcdðeéfghiíjklmnoóprstuúvxyýþæözAÁBCDÐEÉFGHIÍJKLMNOÓPRSTUÚVXYÝÞÆÖZÃ*/!,.<>()&"
HOUSE_RANGE_WORD = " og "


def birthday(national_id: Column | str) -> Column:
    """Birthday in a ten-digit national id.

    First digit 4 to 7 marks a company (day + 40), above 7 a system id without a date. A February day that does
    not exist becomes the 28th; any other impossible date is NULL.
    """
    value = as_column(national_id)
    first = F.substring(value, 1, 1).cast("int")
    day = F.concat(F.when(first < 4, first).otherwise(first - 4).cast("string"), F.substring(value, 2, 1))
    month = F.substring(value, 3, 2)
    last = F.substring(value, 10, 1)
    century = F.lit(None).cast("string")
    for digit, prefix in CENTURY_BY_LAST_DIGIT.items():
        century = F.when(last == digit, F.lit(prefix)).otherwise(century)
    year_month = F.concat(century, F.substring(value, 5, 2), F.lit("-"), month, F.lit("-"))
    exact = F.try_to_date(F.concat(year_month, day), "yyyy-MM-dd")
    february = F.when(
        (month == "02") & (day > "28"), F.try_to_date(F.concat(year_month, F.lit("28")), "yyyy-MM-dd")
    )
    return F.when(value.rlike(r"^[0-7]\d{9}$"), F.coalesce(exact, february))


def age_in_years(born: Column | str, at: Column | str) -> Column:
    """Whole years by mean year length, which is one short on some birthdays (2001-01-01 to 2019-01-01 is 17)."""
    return F.floor(F.date_diff(as_column(at), as_column(born)) / F.lit(DAYS_PER_YEAR)).cast("int")


def of_legal_age(register_code: Column | str, born: Column | str, as_of: Column | str) -> Column:
    """1 or 0: the register code decides where present, else age 18; an unknown birthday counts as adult."""
    code = as_column(register_code)
    return (
        F.when(code.isin(*MINOR_CODES), 0)
        .when(code.isNotNull(), 1)
        .when(age_in_years(born, as_of) < ADULT_AGE, 0)
        .otherwise(1)
    )


def name_parts(name: Column | str) -> tuple[Column, Column, Column]:
    """First, middle and last name by the first and last space; one word stands for every part."""
    value = F.trim(as_column(name))
    words = F.instr(value, " ") > 0
    first = F.substring_index(value, " ", 1)
    last = F.substring_index(value, " ", -1)
    inner = F.length(value) - F.length(first) - F.length(last) - 2
    middle = F.when(inner > 0, F.substr(value, F.length(first) + 2, inner)).otherwise(F.lit(""))
    return (
        first,
        F.when(words, middle).otherwise(value),
        last,
    )


def house_numbers(text: Column | str) -> tuple[Column, Column]:
    """Lowest and highest number of a house-number text such as ``12-14``, ``12 og 14`` or ``7b 2``."""
    dashed = F.replace(as_column(text), F.lit(HOUSE_RANGE_WORD), F.lit("-"))
    blanked = F.trim(F.translate(dashed, HOUSE_BLANKS, " " * len(HOUSE_BLANKS)))
    bare = F.regexp_replace(blanked, "^-+|-+$", "")
    items = F.split(F.substring_index(bare, " ", 1), "-")
    numbers = F.transform(items, lambda item: item.try_cast("int"))
    readable = (F.length(bare) > 0) & F.forall(items, lambda item: (item == "") | item.rlike(r"^\d+$"))
    # An empty item between two dashes counts as zero when the items are ordered, and is no number itself.
    low = F.when(readable & ~F.array_contains(items, ""), F.array_min(numbers))
    return low, F.when(readable, F.array_max(numbers))


def national_id_digits(value: Column) -> tuple[list[Column], Column]:
    """The eight weighted digits and the check digit; -1 and 5000 stand in where the id is not ten digits."""
    well_formed = is_ten_digits(value)
    digits = [
        F.when(well_formed, F.substring(value, i + 1, 1).try_cast("int")).otherwise(-1)
        for i in range(len(NATIONAL_ID_WEIGHTS))
    ]
    return digits, F.when(well_formed, F.substring(value, 9, 1).try_cast("int")).otherwise(5000)


def is_ten_digits(value: Column) -> Column:
    """Never NULL: a NULL value is simply not well formed."""
    return F.coalesce(F.rtrim(value).rlike(r"^\d{10}$"), F.lit(False))


def national_id_sum(value: Column) -> Column:
    """Weighted digit sum."""
    digits, _ = national_id_digits(value)
    total = F.lit(0)
    for digit, weight in zip(digits, NATIONAL_ID_WEIGHTS):
        total = total + digit * weight
    return total


def computed_check_digit(weighted_sum: Column) -> Column:
    """The digit the weighted sum asks for; 10 never matches a digit."""
    rest = weighted_sum % 11
    return F.when(rest == 0, 0).otherwise(11 - rest)


def national_id_error(column: Column | str) -> Column:
    """``null``, ``length``, ``non_numeric`` or ``checksum``; NULL for a good id. Ids starting with 8 or 9 are exempt."""
    value = as_column(column)
    weighted = [
        F.substring(value, i, 1).try_cast("int") * weight for i, weight in enumerate(NATIONAL_ID_WEIGHTS, 1)
    ]
    # Same digit as computed_check_digit for a real sum, with the sum evaluated once.
    wrong = F.substring(value, 9, 1).try_cast("int") != (11 - sum(weighted[1:], weighted[0]) % 11) % 11
    exempt = F.substring(value, 1, 1).isin("8", "9")
    return (
        F.when(value.isNull(), F.lit("null"))
        .when(F.length(F.rtrim(value)) != 10, F.lit("length"))
        .when(~is_ten_digits(value), F.lit("non_numeric"))
        .when(~exempt & wrong, F.lit("checksum"))
    )
