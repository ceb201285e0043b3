"""Moving statistics of one field.

The column functions take the frame's window; the `add_*` functions work on a
DataFrame of many series and are safe for series of any length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from candlemill.operators.series import over_series, preceding


def moving_average(field: Column | str, window: int, spec: WindowSpec | None = None) -> Column:
    return F.avg(field).over(preceding(window, spec))


def price_change(field: Column | str, window: int = 1, spec: WindowSpec | None = None) -> Column:
    """Last minus first value of the frame; 0.0 on the first row of a series."""
    frame = preceding(window, spec)
    return F.last(field).over(frame) - F.first(field).over(frame)


def moving_stddev(field: Column | str, window: int, spec: WindowSpec | None = None) -> Column:
    """Sample deviation; NULL for a frame of one row."""
    return F.stddev_samp(field).over(preceding(window, spec))


def moving_highest(field: Column | str, window: int, spec: WindowSpec | None = None) -> Column:
    return F.max(field).over(preceding(window, spec))


def moving_lowest(field: Column | str, window: int, spec: WindowSpec | None = None) -> Column:
    return F.min(field).over(preceding(window, spec))


def _add(df: DataFrame, make: Callable[..., Column], field: str, window: int, name: str, series: dict) -> DataFrame:
    return over_series(df, window, lambda d, w: d.withColumn(name, make(field, window, w)), **series)


def add_moving_average(df: DataFrame, field: str, window: int, name: str = "in_MA", **series) -> DataFrame:
    return _add(df, moving_average, field, window, name, series)


def add_price_change(df: DataFrame, field: str, window: int = 1, name: str = "in_change", **series) -> DataFrame:
    return _add(df, price_change, field, window, name, series)


def add_moving_stddev(df: DataFrame, field: str, window: int, name: str = "in_dev_pad", **series) -> DataFrame:
    return _add(df, moving_stddev, field, window, name, series)


def add_moving_highest(df: DataFrame, field: str, window: int, name: str = "in_highest", **series) -> DataFrame:
    return _add(df, moving_highest, field, window, name, series)


def add_moving_lowest(df: DataFrame, field: str, window: int, name: str = "in_lowest", **series) -> DataFrame:
    return _add(df, moving_lowest, field, window, name, series)
