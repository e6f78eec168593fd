"""Dates and times from text."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .common import as_column

CENTURY_CUTOFF = 49  # two-digit years up to 49 are 20xx, later ones 19xx


def _date_parts(text: Column, mask: str) -> tuple[Column, Column, Column]:
    """Trimmed text, its length, and the ISO text built from the positions the mask names."""
    for part in ("DD", "MM", "YY"):
        if part not in mask:
            raise ValueError(f"mask {mask!r} lacks {part}")
    value = F.trim(text)
    size = F.length(value)
    day = F.substring(value, mask.index("DD") + 1, 2)
    month = F.substring(value, mask.index("MM") + 1, 2)
    short_year = F.substring(value, mask.index("YY") + 1, 2)
    century = F.when(short_year <= str(CENTURY_CUTOFF), F.lit("20")).otherwise(F.lit("19"))
    long_year = F.substring(value, mask.index("YYYY") + 1, 4) if "YYYY" in mask else F.lit("")
    year = F.when(size == 6, F.concat(century, short_year)).otherwise(long_year)
    return value, size, F.concat_ws("-", year, month, day)


def conform_date(text: Column | str, mask: str) -> Column:
    """Date from text by a DD/MM/YY or DD/MM/YYYY mask.

    Text shorter than the mask, or exactly seven characters long, gives NULL; longer text may carry a time.
    An impossible date gives NULL here instead of failing the statement; see :func:`date_reason`.
    """
    _, size, iso = _date_parts(as_column(text), mask)
    usable = (size >= len(mask)) & ((size == 6) | (size >= 8)) & iso.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.when(usable, F.try_to_date(iso, "yyyy-MM-dd"))


def date_reason(text: Column | str, mask: str, conformed: Column | str | None = None) -> Column:
    """Why :func:`conform_date` gave NULL: ``missing``, ``too short`` or ``invalid``; NULL for a good date.

    ``conformed`` is the date if it has been computed already.
    """
    text = as_column(text)
    result = conform_date(text, mask) if conformed is None else as_column(conformed)
    return (
        F.when(text.isNull(), F.lit("missing"))
        .when(F.length(F.trim(text)) < len(mask), F.lit("too short"))
        .when(result.isNull(), F.lit("invalid"))
    )


VALID_TIME = r"^([01]\d|2[0-3]):[0-5]\d(:[0-5]\d)?$"


def read_time(text: Column | str, separator: str = ":") -> Column:
    """``HH:mm:ss`` from text such as ``5`` (minutes), ``930``, ``1230``, ``123015`` or ``12:30``; NULL if unreadable.

    Short text is padded with zeros to four characters. A colon is inserted before the third character unless a
    separator stands there, and before the sixth unless one stands third from the end. Each step is a replacement
    of the one before, so the expression does not repeat its input.
    """
    value = as_column(text)
    mark = re.escape(separator)
    padded = F.lpad(value, F.greatest(F.length(value), F.lit(4)), F.lit("0"))
    minutes = F.regexp_replace(padded, f"^(..)(?!{mark})", "$1:")
    seconds = F.regexp_replace(minutes, f"^(?!.*{mark}[^{mark}]{{2}}$)(.{{5}})(.+)$", "$1:$2")
    return F.when(seconds.rlike(VALID_TIME), F.rpad(seconds, 8, ":00"))


def conform_time(text: Column | str, default: str | None = None, separator: str = ":") -> Column:
    """Time of day as ``HH:mm:ss`` text; NULL or unreadable text gives the default (NULL if that is unreadable)."""
    return F.coalesce(read_time(text, separator), default_time(default))


def default_time(default: str | None) -> Column:
    """The default as ``HH:mm:ss`` text, NULL if it is no time."""
    value = F.lit(default).cast("string")
    return F.when(value.rlike(VALID_TIME), F.rpad(value, 8, ":00"))


def time_reason(text: Column | str, read: Column | str) -> Column:
    """Why the default was used: ``missing`` or ``invalid``; NULL where ``read`` holds a time."""
    return F.when(as_column(text).isNull(), F.lit("missing")).when(as_column(read).isNull(), F.lit("invalid"))


def second_of_day(time_text: Column | str) -> Column:
    """Seconds since midnight of ``HH:mm:ss`` text."""
    value = as_column(time_text)
    hour, minute, second = (F.substring(value, at, 2).cast("int") for at in (1, 4, 7))
    return hour * 3600 + minute * 60 + second
