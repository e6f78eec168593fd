"""Edit distance."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .common import as_column


def edit_distance(left: Column | str, right: Column | str, maximum: int | None = None, fold_case: bool = True) -> Column:
    """Levenshtein distance, NULL beyond ``maximum`` (None: no limit) and for NULL input."""
    left, right = as_column(left), as_column(right)
    if fold_case:
        left, right = F.lower(left), F.lower(right)
    if maximum is None:
        return F.levenshtein(left, right)
    return F.nullif(F.levenshtein(left, right, maximum), F.lit(-1))

