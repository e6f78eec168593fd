"""Business keys and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .common import as_column

# The 26 characters that a constructed key may not hold.
KEY_PUNCTUATION = ' .,:;-/?!()[]*#$%&=@><|^~"'
NULL_PART = "NULL"
MAX_KEY_PARTS = 5


def construct_key(*parts: Column | str) -> Column:
    """One to five parts, upper-cased and joined by ``_``; a NULL part reads ``NULL``, punctuation becomes ``_``."""
    if not 1 <= len(parts) <= MAX_KEY_PARTS:
        raise ValueError(f"a key has 1 to {MAX_KEY_PARTS} parts, got {len(parts)}")
    texts = [F.coalesce(F.upper(as_column(p).cast("string")), F.lit(NULL_PART)) for p in parts]
    return F.translate(F.concat_ws("_", *texts), KEY_PUNCTUATION, "_" * len(KEY_PUNCTUATION))


def surrogate_key(*fields: Column | str) -> Column:
    """MD5 of the fields as text, NULL as empty text, joined by ``-``.

    The text is hashed as UTF-8, so keys of non-ASCII text can differ from a single-byte server's.
    """
    if not fields:
        raise ValueError("a surrogate key needs at least one field")
    texts = [F.coalesce(as_column(f).cast("string"), F.lit("")) for f in fields]
    return F.md5(F.concat_ws("-", *texts))
