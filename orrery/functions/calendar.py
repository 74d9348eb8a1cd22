"""Calendar attributes of a date, as plain column expressions (ISO weeks, two languages)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Language:
    quarter_letter: str
    week_letter: str
    months: tuple[str, ...]
    days: tuple[str, ...]


# Labels that calendar rows must carry.
LANGUAGES = {
    "en": Language(
        "Q",
        "W",
        (
            "January", "February", "March", "April", "May", "June",
            "July", "August", "September", "October", "November", "December",
        ),
        ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"),
    ),
    "fr": Language(
        "T",
        "S",
        (
            "janvier", "février", "mars", "avril", "mai", "juin",
            "juillet", "août", "septembre", "octobre", "novembre", "décembre",
        ),
        ("lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche"),
    ),
}


def language(code: str) -> Language:
    if code not in LANGUAGES:
        raise ValueError(f"unknown language {code!r}, expected one of {sorted(LANGUAGES)}")
    return LANGUAGES[code]


def _label(labels: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), position)


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer; arithmetic only, since it runs on every fact row."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def iso_day(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(day) + 1


def iso_week_label(day: Column, letter: str) -> Column:
    iso_year = F.extract(F.lit("YEAROFWEEK"), day)
    week = F.lpad(F.weekofyear(day).cast("string"), 2, "0")
    return F.concat(iso_year.cast("string"), F.lit("-" + letter), week)


def quarter_label(day: Column, letter: str) -> Column:
    return F.concat(
        F.year(day).cast("string"), F.lit("-" + letter), F.quarter(day).cast("string")
    )


def is_weekend(day: Column) -> Column:
    return iso_day(day).isin(6, 7)


def calendar_columns(day: Column, lang: str = "en") -> list[Column]:
    """The fourteen columns of the calendar dimension, in table order."""
    words = language(lang)
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).cast("smallint").alias("year_num"),
        F.quarter(day).cast("smallint").alias("quarter_num"),
        quarter_label(day, words.quarter_letter).alias("quarter_label"),
        F.month(day).cast("smallint").alias("month_num"),
        _label(words.months, F.month(day)).alias("month_name"),
        year_month(day).alias("year_month"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
        iso_week_label(day, words.week_letter).alias("year_week"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        iso_day(day).cast("smallint").alias("day_of_week"),
        _label(words.days, iso_day(day)).alias("day_name"),
        is_weekend(day).alias("is_weekend"),
    ]
