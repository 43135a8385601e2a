"""YYYYMMDD integers: validity, day numbers, arithmetic, text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digits(ymd: Column) -> Column:
    return ymd.try_cast("double").try_cast("bigint").cast("string")


def ymd_to_date(ymd: Column) -> Column:
    """Date of a YYYYMMDD number or string (20170228.0 included); NULL when there is no such day."""
    text = _digits(ymd)
    return F.when(F.length(text) == 8, F.try_to_date(text, "yyyyMMdd"))


def date_to_ymd(date: Column) -> Column:
    return (F.year(date) * 10000 + F.month(date) * 100 + F.day(date)).cast("int")


def iso_to_ymd(text: Column) -> Column:
    """``2017-02-28`` to 20170228; NULL for any other text."""
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.regexp_replace(text, "-", "").cast("int"))


def ymd_to_iso(ymd: Column) -> Column:
    """20170228 to ``2017-02-28``; empty text when the value has not exactly eight digits."""
    text = F.coalesce(ymd.cast("string"), F.lit(""))
    return F.when(
        text.rlike("^[0-9]{8}$"),
        F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)),
    ).otherwise("")


def ymd_to_days(ymd: Column) -> Column:
    """Days since 1970-01-01. A month or day outside its range rolls over, as in a calendar calculator."""
    value = ymd.cast("bigint")
    year = F.floor(value / 10000)
    month = F.floor(value / 100) % 100 - 1
    first = F.make_date(
        (year + F.floor(month / 12)).cast("int"), (F.pmod(month, F.lit(12)) + 1).cast("int"), F.lit(1)
    )
    return F.unix_date(first) + (value % 100).cast("int") - 1


def add_days_ymd(ymd: Column, days: Column | int) -> Column:
    number = ymd_to_days(ymd) + (F.lit(days) if isinstance(days, int) else days)
    return date_to_ymd(F.date_from_unix_date(number.cast("int")))


def epoch_seconds(moment: Column) -> Column:
    """Seconds since 1970 of a date or timestamp; NULL stays NULL."""
    return F.unix_timestamp(moment.cast("timestamp"))


def latest(dates: Column) -> Column:
    """Maximum of a list-valued date cell."""
    return F.array_max(dates)
