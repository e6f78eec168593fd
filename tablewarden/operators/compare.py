"""Comparison of two relations, and schema drift between a table and its history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.common import own_shuffle

MAX_TEXT = 8000
TEXT_TYPES = ("string", "char", "varchar")
PRECISE_TYPES = ("decimal",)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _keys(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Each key once with its row count; copies shrink to one row per task before the shuffle."""
    return df.groupBy(*[F.col(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias(f"{prefix}n"))


def compare_summary(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts of both sides and the number of keys only one side has (keys with a NULL are not counted)."""
    left, right = _keys(first, keys, "f"), _keys(second, keys, "s")
    same = _all([F.col(f"f{i}") == F.col(f"s{i}") for i in range(len(keys))])
    whole_left = _all([F.col(f"f{i}").isNotNull() for i in range(len(keys))])
    whole_right = _all([F.col(f"s{i}").isNotNull() for i in range(len(keys))])
    return left.join(right, same, "full_outer").agg(
        F.coalesce(F.sum("fn"), F.lit(0)).alias("first_count"),
        F.coalesce(F.sum("sn"), F.lit(0)).alias("second_count"),
        F.count_if(F.col("sn").isNull() & whole_left).alias("only_in_first"),
        F.count_if(F.col("fn").isNull() & whole_right).alias("only_in_second"),
    )


def only_in_first(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the first side whose key the second lacks; a NULL key is never matched."""
    named = [F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)]
    other = second.groupBy(*named, own_shuffle(*keys)).agg(F.lit(1)).select(*[f"_s{i}" for i in range(len(keys))])
    same = _all([F.col(k) == F.col(f"_s{i}") for i, k in enumerate(keys)])
    return first.join(other, same, "left_anti")


def only_in_second(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    return only_in_first(second, first, keys)


def _common(first: DataFrame, second: DataFrame, ignore: Sequence[str]) -> list[str]:
    return [c for c in first.columns if c in second.columns and c not in ignore]


# Rows of one key that one task may put in order; a key with more is cut at digits of its rows' digests.
ROWS_IN_ORDER = 65_536


def _back(column: Column, kind: T.DataType) -> Column:
    return column.cast(kind) if isinstance(kind, T.AtomicType) else column


def _surplus(rows: DataFrame, keys: Sequence[str], used: Sequence[str]) -> DataFrame:
    """Rows that one side holds more often, where both sides hold the key, with their position among such rows.

    Positions follow the digest of the row. They count on from part to part of a key, so a key that owns most rows is
    ordered by many tasks.
    """
    counted = rows.groupBy(*used).agg(F.sum("_first").alias("_f"), F.sum(1 - F.col("_first")).alias("_s"))
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    held = rows.groupBy(*named, own_shuffle(*keys)).agg(F.sum("_first").alias("_n"), F.sum(1 - F.col("_first")).alias("_m"))
    parts = F.floor(F.greatest("_n", "_m") / ROWS_IN_ORDER)
    held = held.filter("_n > 0 and _m > 0").select(
        *[f"_k{i}" for i in range(len(keys))], F.when(parts > 0, F.length(F.hex(parts))).otherwise(0).alias("_digits")
    )
    same = _all([F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)])
    texts = [F.coalesce(F.concat(F.lit(":"), F.col(c).cast("string")), F.lit("")) for c in used]
    left = (
        counted.filter("_f <> _s")
        .join(held, same)
        .withColumn("_mark", F.md5(F.concat_ws("|", *texts)))
        .select(
            *used, "_mark", (F.col("_f") > F.col("_s")).alias("_of_first"), F.abs(F.col("_f") - F.col("_s")).alias("_copies"),
            F.expr("substring(_mark, 1, _digits)").alias("_part"),
        )
    )
    group = [*keys, "_of_first"]
    sizes = left.groupBy(*group, "_part").agg(F.sum("_copies").alias("_size"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group, "_part").orderBy("_mark").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = left.withColumn("_last", F.sum("_copies").over(inside)).join(offsets, [*group, "_part"])
    last = F.col("_offset") + F.col("_last")
    return placed.select(*used, "_of_first", F.explode(F.sequence(last - F.col("_copies") + 1, last)).alias("_at"))


def data_difference(
    first: DataFrame, second: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """Rows with equal keys whose common columns differ: names of the differing columns and both values.

    Comparison is null-safe; columns of different types are compared as text. Rows without a key are left out, as are
    keys of one side. Where a key names several rows, rows that are equal on both sides cancel out first, copy by copy.
    The rest of both sides is matched one to one in the order of the rows' MD5 digests; rows left over have NULL in all
    columns of the other side, its key included, and name every compared column. So n and m rows of one key give at
    most max(n, m) rows, never n times m.
    """
    theirs, mine = {f.name: f.dataType for f in second.schema}, {f.name: f.dataType for f in first.schema}
    common = _common(first, second, ignore)
    used = list(dict.fromkeys([*keys, *common]))
    compared = [c for c in common if c not in keys]

    def as_text(column: str) -> bool:
        both = mine[column], theirs[column]
        return both[0] != both[1] and not (column in keys and all(isinstance(t, T.NumericType) for t in both))

    def side(df: DataFrame, in_first: int) -> DataFrame:
        columns = [F.col(c).cast("string").alias(c) if as_text(c) else F.col(c) for c in used]
        return df.select(*columns, F.lit(in_first).alias("_first")).filter(_all([F.col(k).isNotNull() for k in keys]))

    rows = side(first, 1).unionByName(side(second, 0))
    row = F.struct(*used)
    pairs = _surplus(rows, keys, used).groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_at").agg(
        F.first(F.when(F.col("_of_first"), row), ignorenulls=True).alias("_f"),
        F.first(F.when(~F.col("_of_first"), row), ignorenulls=True).alias("_s"),
    )
    alone = F.col("_f").isNull() | F.col("_s").isNull()
    names = [F.when(alone | ~F.col(f"_f.{c}").eqNullSafe(F.col(f"_s.{c}")), F.lit(c)) for c in compared]
    shown = [
        _back(F.col(f"_{p}.{c}"), types[c]).alias(f"{p}_{c}") for c in common for p, types in (("f", mine), ("s", theirs))
    ]
    return (
        pairs.withColumn("differing_columns", F.concat_ws(" ", *names) if names else F.lit(""))
        .filter("differing_columns <> ''")
        .select("differing_columns", *shown)
    )


def row_difference(first: DataFrame, second: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows that one side holds more often than the other, with both counts; needs no key.

    Rows are counted, never paired: copies of a row shrink to one per task before the shuffle, however many there
    are. Columns of different types are compared as text.
    """
    theirs, mine = dict(second.dtypes), dict(first.dtypes)

    def side(df: DataFrame, in_first: int) -> DataFrame:
        columns = [
            F.col(c) if mine[c] == theirs[c] else F.col(c).cast("string").alias(c) for c in _common(first, second, ignore)
        ]
        return df.select(*columns, F.lit(in_first).alias("_first"))

    rows = side(first, 1).unionByName(side(second, 0))
    counted = rows.groupBy(*[c for c in rows.columns if c != "_first"]).agg(
        F.sum("_first").alias("first_count"), F.sum(1 - F.col("_first")).alias("second_count")
    )
    return counted.filter("first_count <> second_count")


# History hash and creation date, which say nothing when versions are compared; ours, then Icelandic names.
VERSION_BOOKKEEPING = ("row_hash", "valid_from", "saga_taetigildi", "stofndagur")


def version_difference(
    first: DataFrame, second: DataFrame, keys: Sequence[str], ignore: Sequence[str] = VERSION_BOOKKEEPING
) -> DataFrame:
    """:func:`data_difference` between two versions of a relation, without their bookkeeping columns."""
    return data_difference(first, second, keys, ignore)


def schema_drift(public: DataFrame, history: DataFrame) -> DataFrame:
    """Columns whose type or text length differs between two inventories, with the type the history should have."""
    p, h = public.alias("p"), history.alias("h")
    same = (F.col("p.relation_name") == F.col("h.relation_name")) & (F.col("p.column_name") == F.col("h.column_name"))
    differs = (F.col("p.data_type") != F.col("h.data_type")) | (F.col("p.char_length") != F.col("h.char_length"))
    length, kind = F.col("p.char_length"), F.col("p.data_type")
    bounded = F.when(length > 0, length).otherwise(MAX_TEXT).cast("string")
    corrective = (
        F.when(kind.isin(*TEXT_TYPES), F.concat(F.when(kind == "string", F.lit("varchar")).otherwise(kind), F.lit("("), bounded, F.lit(")")))
        .when(
            kind.isin(*PRECISE_TYPES),
            F.concat(kind, F.lit("("), F.col("p.numeric_precision").cast("string"), F.lit(","), F.col("p.numeric_scale").cast("string"), F.lit(")")),
        )
        .otherwise(kind)
    )
    return p.join(h, same & differs).select(
        F.col("p.schema_name").alias("schema_name"),
        F.col("p.relation_name").alias("relation_name"),
        F.col("p.column_name").alias("column_name"),
        kind.alias("public_data_type"),
        length.alias("public_length"),
        F.col("h.data_type").alias("history_data_type"),
        F.col("h.char_length").alias("history_length"),
        corrective.alias("corrective_type"),
    )
