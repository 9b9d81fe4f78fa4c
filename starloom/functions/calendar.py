"""Month and calendar helpers."""

from __future__ import annotations

import re
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MONTH = re.compile(r"\d{4}-(0[1-9]|1[0-2])")


def month_bounds(month: str) -> tuple[date, date]:
    """First day of 'YYYY-MM' and of the month after it."""
    if not _MONTH.fullmatch(month):
        raise ValueError(f"not a month (YYYY-MM): {month!r}")
    year, number = int(month[:4]), int(month[5:])
    return date(year, number, 1), date(year + number // 12, number % 12 + 1, 1)


def in_month(column: str | Column, month: str) -> Column:
    """Month equality as a half-open range, which reaches the Parquet scan as a pushed filter."""
    first, following = month_bounds(month)
    column = F.col(column) if isinstance(column, str) else column
    return (column >= F.lit(first)) & (column < F.lit(following))


def month_start(column: str | Column) -> Column:
    return F.trunc(column, "MM")


def month_label(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM")


def date_attributes(column: str) -> list[Column]:
    """The seven calendar attributes of a date column. ISO weekdays run from Monday = 1."""
    day = F.col(column)
    iso_weekday = F.weekday(day) + 1
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        iso_weekday.alias("iso_weekday"),
        F.date_format(day, "EEEE").alias("weekday_name"),
        iso_weekday.isin(6, 7).alias("is_weekend"),
    ]


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from `start` up to, not including, `end`."""
    days = spark.range((end - start).days)
    return days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day"))


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def timestamp(value: datetime) -> Column:
    """Literal without time zone, so that the session zone cannot shift it."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
