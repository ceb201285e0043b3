"""Row formulas of the indicators as native column expressions.

NULL in gives NULL out. NaN counts as "not greater": Spark orders NaN above
every number, so the comparisons exclude it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BAND_WIDTH = 2.0
NO_LOSS_MODES = ("zero", "textbook")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _positive(c: Column) -> Column:
    return (c > 0) & ~F.isnan(c)


def safe_division(num: Column | str, denum: Column | str) -> Column:
    """Quotient, or 0.0 where the denominator is not positive."""
    num, denum = _col(num), _col(denum)
    known = num.isNotNull() & denum.isNotNull()
    return F.when(known & _positive(denum), num / denum).when(known, F.lit(0.0))


def gain(change: Column | str) -> Column:
    change = _col(change)
    return F.when(_positive(change), change).when(change.isNotNull(), F.lit(0.0))


def loss(change: Column | str) -> Column:
    change = _col(change)
    return F.when(change < 0, -change).when(change.isNotNull(), F.lit(0.0))


def rsi_from_ratio(ratio: Column | str) -> Column:
    """100 - 100 / (1 + ratio), and 0.0 at the pole."""
    ratio = _col(ratio)
    return F.when(ratio == -1, F.lit(0.0)).otherwise(F.lit(100.0) - F.lit(100.0) / (ratio + 1.0))


def rsi_from_averages(avg_gain: Column, avg_loss: Column, zero_loss: str = "zero") -> Column:
    """RSI of two averages.

    Without any loss in the frame the ratio is 0 and so is the RSI; with
    `zero_loss="textbook"` such a frame gives 100 if it has a gain.
    """
    if zero_loss not in NO_LOSS_MODES:
        raise ValueError(f"zero_loss must be one of {NO_LOSS_MODES}")
    value = rsi_from_ratio(safe_division(avg_gain, avg_loss))
    if zero_loss == "textbook":
        value = F.when((avg_loss == 0) & _positive(avg_gain), F.lit(100.0)).otherwise(value)
    return value


def stochastic_k(close: Column | str, highest: Column | str, lowest: Column | str) -> Column:
    """Place of the close in the range, in percent; 0.0 for an empty range."""
    close, highest, lowest = _col(close), _col(highest), _col(lowest)
    return safe_division(close - lowest, highest - lowest) * 100


def bollinger_lower(middle: Column | str, deviation: Column | str) -> Column:
    return _col(middle) - F.lit(BAND_WIDTH) * _col(deviation)


def bollinger_upper(middle: Column | str, deviation: Column | str) -> Column:
    return _col(middle) + F.lit(BAND_WIDTH) * _col(deviation)
