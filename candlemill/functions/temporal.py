"""Epoch numbers, calendar columns and bar starts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from candlemill.schema import MINUTES

# Fixed value: larger open times are microseconds, others milliseconds.
LARGEST_MILLIS = 9_999_999_999_999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_timestamp(opentime: Column | str) -> Column:
    """Milliseconds or microseconds since 1970 as a timestamp in whole seconds."""
    opentime = _col(opentime)
    exact = F.when(opentime > LARGEST_MILLIS, F.timestamp_micros(opentime)).otherwise(F.timestamp_millis(opentime))
    return F.date_trunc("second", exact)


def calendar_columns(timestamp: Column | str = "cuote_timestamp") -> dict[str, Column]:
    """For `df.withColumns(...)`."""
    timestamp = _col(timestamp)
    return {
        "cuote_date": F.to_date(timestamp),
        "cuote_year": F.year(timestamp),
        "cuote_month": F.month(timestamp),
    }


def bar_start(timestamp: Column | str, timeframe: str) -> Column:
    """Start of the bar that holds `timestamp`; weeks start on Monday."""
    timestamp = _col(timestamp)
    day = F.to_date(timestamp)
    minutes = MINUTES[timeframe]
    if timeframe == "1w":
        return F.trunc(day, "week").cast("timestamp")
    if minutes == 1440:
        return day.cast("timestamp")
    minute_of_day = F.hour(timestamp) * 60 + F.minute(timestamp)
    offset = minute_of_day - minute_of_day % minutes
    return day.cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), offset)
