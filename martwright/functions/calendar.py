"""Date keys and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column | str) -> Column:
    """Integer yyyymmdd, computed without formatting text."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def day_of(key: Column | str) -> Column:
    """The date behind a date key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.make_date(F.floor(key / 10000), F.floor(key / 100) % 100, key % 100)


def calendar_columns(day: str) -> list[Column]:
    """All attributes of the date dimension; weekday 1 is Sunday, weeks are ISO weeks."""
    return [
        date_key(day).alias("date_key"),
        F.col(day).alias("full_date"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).alias("day_of_week"),
        F.weekofyear(day).alias("week"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    ]
