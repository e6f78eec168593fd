"""Date and time dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

DEFAULT_START = date(2010, 1, 1)
DEFAULT_END = date(2040, 12, 31)
SECONDS_PER_DAY = 86_400


@dataclass(frozen=True)
class Locale:
    """Month names from January and weekday names from Monday."""

    months: Sequence[str]
    weekdays: Sequence[str]


# Icelandic names.
ICELANDIC = Locale(
    months=(
        "Janúar", "Febrúar", "Mars", "Apríl", "Maí", "Júní",
        "Júlí", "Ágúst", "September", "Október", "Nóvember", "Desember",
    ),
    weekdays=(
        "Mánudagur", "Þriðjudagur", "Miðvikudagur", "Fimmtudagur", "Föstudagur", "Laugardagur", "Sunnudagur",
    ),
)

# Icelandic column names of the date dimension, in column order.
DATE_COLUMNS_ICELANDIC = {
    "id": "id",
    "weekday": "vikudagur",
    "weekday_name": "vikudagur_heiti",
    "is_weekend": "er_helgi",
    "is_workday": "er_virkur_dagur",
    "week_of_year": "vika_numer_innan_ars",
    "iso_week_of_year": "vika_numer_innan_ars_iso",
    "weekday_of_month": "vika_numer_innan_manadar",
    "week_start": "vika_fyrsta_dagsetning",
    "week_end": "vika_sidasta_dagsetning",
    "week_of_month": "vika_numer_manadar",
    "day_of_month": "manadardagur",
    "month": "manudur",
    "month_start": "manudur_upphafsdagsetning",
    "month_end": "manudur_lokadagsetning",
    "month_name": "manudur_heiti",
    "month_short_name": "manudur_heiti_3",
    "next_month_start": "upphafsdagsetning_naesta_manudar",
    "next_month_end": "lokadagsetning_naesta_manudar",
    "quarter": "arsfjordungur",
    "quarter_start": "arsfjordungur_upphafsdagsetning",
    "quarter_end": "arsfjordungur_lokadagsetning",
    "year": "ar",
    "iso_year": "ar_iso",
    "is_leap_year": "er_hlaupar",
    "day_of_year": "ar_numer_dags",
    "year_start": "ar_upphafsdagsetning",
    "year_end": "ar_lokadagsetning",
    "has_53_weeks": "ar_inniheldur_53_vikur",
    "has_53_iso_weeks": "ar_inniheldur_53_iso_vikur",
    "year_month": "ar_manudur",
}

# Icelandic column names of the time dimension.
TIME_COLUMNS_ICELANDIC = {
    "id": "id",
    "hour": "klukkutimi",
    "minute": "minuta",
    "second": "sekunda",
    "is_daytime": "dagtimi",
    "is_night": "nott",
    "is_morning": "morgun",
    "is_evening": "kvold",
}


def week_of_year(day: Column) -> Column:
    """Week number with weeks from Monday and 1 January in week 1, so 31 December 2012 is in week 54."""
    new_year = F.trunc(day, "year")
    return (F.floor((F.dayofyear(day) - 1 + F.weekday(new_year)) / 7) + 1).cast("int")


def days_between(spark: SparkSession, start: date = DEFAULT_START, end: date = DEFAULT_END) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("id"))


def days_of(df: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last date in a column."""
    span = df.agg(F.min(F.to_date(column)).alias("first"), F.max(F.to_date(column)).alias("last"))
    return span.filter("first is not null").select(F.explode(F.sequence("first", "last")).alias("id"))


def date_dimension(days: DataFrame, locale: Locale = ICELANDIC, names: Mapping[str, str] | None = None) -> DataFrame:
    """The calendar attributes of the days in ``id``; ``names`` renames columns (``DATE_COLUMNS_ICELANDIC`` all).

    Month and quarter bounds that depend on neighbours are taken within the given days. Every window is one month
    or one quarter. The 53-week flags look at the week of 31 December (its ISO week may be 1).
    """
    day = F.col("id")
    month_names = F.array(*[F.lit(m) for m in locale.months])
    weekday_names = F.array(*[F.lit(w) for w in locale.weekdays])
    year_end = F.make_date(F.year(day), F.lit(12), F.lit(31))
    month_start = F.trunc(day, "month").cast("date")
    weekday = F.weekday(day) + 1
    base = days.select(
        "id",
        weekday.alias("weekday"),
        F.element_at(weekday_names, weekday).alias("weekday_name"),
        F.when(weekday > 5, 1).otherwise(0).alias("is_weekend"),
        F.when(weekday > 5, 0).otherwise(1).alias("is_workday"),
        week_of_year(day).alias("week_of_year"),
        F.weekofyear(day).alias("iso_week_of_year"),
        F.date_sub(day, weekday - 1).alias("week_start"),
        F.date_add(day, 7 - weekday).alias("week_end"),
        F.dayofmonth(day).alias("day_of_month"),
        F.month(day).alias("month"),
        month_start.alias("month_start"),
        F.element_at(month_names, F.month(day)).alias("month_name"),
        F.add_months(month_start, 1).alias("next_month_start"),
        F.date_sub(F.add_months(month_start, 2), 1).alias("next_month_end"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.dayofyear(day).alias("day_of_year"),
        F.make_date(F.year(day), F.lit(1), F.lit(1)).alias("year_start"),
        year_end.alias("year_end"),
        F.when(F.dayofyear(year_end) == 366, 1).otherwise(0).alias("is_leap_year"),
        F.when(week_of_year(year_end) == 53, 1).otherwise(0).alias("has_53_weeks"),
        F.when(F.weekofyear(year_end) == 53, 1).otherwise(0).alias("has_53_iso_weeks"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
    )
    month = Window.partitionBy("year", "month")
    quarter = Window.partitionBy("year", "quarter")
    shift = F.when((F.col("month") == 1) & (F.col("iso_week_of_year") > 51), -1).when(
        (F.col("month") == 12) & (F.col("iso_week_of_year") == 1), 1
    ).otherwise(0)
    full = (
        base.withColumn("quarter_start", F.min("id").over(quarter))
        .withColumn("quarter_end", F.max("id").over(quarter))
        .withColumn("month_end", F.max("id").over(month))
        .withColumn("week_of_month", F.dense_rank().over(month.orderBy("week_of_year")))
        .withColumn("weekday_of_month", F.row_number().over(Window.partitionBy("year", "month", "weekday").orderBy("id")))
        .withColumn("month_short_name", F.left("month_name", F.lit(3)))
        .withColumn("iso_year", F.col("year") + shift)
    )
    return full.select(*DATE_COLUMNS_ICELANDIC).withColumnsRenamed(names or {})


def time_dimension(spark: SparkSession, names: Mapping[str, str] | None = None) -> DataFrame:
    """Every second of a day: ``HH:mm:ss``, its parts, and part-of-day flags (morning and daytime overlap).
    ``names`` renames columns (``TIME_COLUMNS_ICELANDIC`` all)."""
    second = F.col("s").cast("int")
    parts = spark.range(SECONDS_PER_DAY).toDF("s").select(
        F.floor(second / 3600).cast("int").alias("hour"),
        F.floor(second / 60 % 60).cast("int").alias("minute"),
        (second % 60).alias("second"),
    )

    def flag(low: int, high: int) -> Column:
        return F.when(F.col("hour").between(low, high), 1).otherwise(0)

    return parts.select(
        F.format_string("%02d:%02d:%02d", "hour", "minute", "second").alias("id"),
        "hour",
        "minute",
        "second",
        flag(8, 17).alias("is_daytime"),
        flag(0, 5).alias("is_night"),
        flag(6, 9).alias("is_morning"),
        flag(18, 23).alias("is_evening"),
    ).withColumnsRenamed(names or {})
