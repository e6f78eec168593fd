"""Phone numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .common import as_column

DEFAULT_COUNTRY_CODE = "354"


def e164_digits(phone: Column | str, country_code: str = DEFAULT_COUNTRY_CODE) -> Column:
    """Digits of an E.164 number: separators and a leading ``00`` dropped, short numbers get the country code.

    Each step is a replacement of the one before, so the expression does not repeat its input.
    """
    bare = F.regexp_replace(as_column(phone), "[-+ ]", "")
    international = F.regexp_replace(bare, "^00(?=.)", "")
    return F.regexp_replace(international, "^(.{0,9})$", f"{country_code}$1")


def msisdn(phone: Column | str, country_code: str = DEFAULT_COUNTRY_CODE) -> Column:
    """MSISDN with its plus sign: seven-digit numbers get the country code."""
    bare = F.regexp_replace(as_column(phone), "[- ]", "")
    return F.regexp_replace(F.regexp_replace(bare, "^(.{7})$", f"{country_code}$1"), r"^(?!\+)", "+")
