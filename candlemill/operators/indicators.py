"""RSI, Bollinger bands and stochastic oscillator.

`window` is the number of rows before the current one, so frames hold
window + 1 rows; the first rows of a series have shorter frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec, functions as F

from candlemill.functions.scalar import (
    bollinger_lower,
    bollinger_upper,
    gain,
    loss,
    rsi_from_averages,
    stochastic_k,
)
from candlemill.operators.moving import (
    moving_average,
    moving_highest,
    moving_lowest,
    moving_stddev,
    price_change,
)
from candlemill.operators.series import over_series

_AVG_GAIN, _AVG_LOSS = "__avg_gain", "__avg_loss"
_CHANGE, _GAIN, _LOSS, _DEV, _HIGH, _LOW = "__change", "__gain", "__loss", "__dev", "__high", "__low"


def _rsi(df: DataFrame, spec: WindowSpec, window: int, zero_loss: str) -> DataFrame:
    moved = df.withColumn(_CHANGE, price_change("cuote_close", 1, spec)).withColumns(
        {_GAIN: gain(_CHANGE), _LOSS: loss(_CHANGE)}
    )
    # As columns first: an expression that repeats a window is computed as often.
    averaged = moved.withColumns(
        {_AVG_GAIN: moving_average(_GAIN, window, spec), _AVG_LOSS: moving_average(_LOSS, window, spec)}
    )
    value = rsi_from_averages(F.col(_AVG_GAIN), F.col(_AVG_LOSS), zero_loss)
    return averaged.withColumn("in_RSI", value).drop(_CHANGE, _GAIN, _LOSS, _AVG_GAIN, _AVG_LOSS)


def _bollinger(df: DataFrame, spec: WindowSpec, window: int) -> DataFrame:
    base = df.withColumns(
        {
            "in_BBandMiddle": moving_average("cuote_close", window, spec),
            _DEV: moving_stddev("cuote_close", window, spec),
        }
    )
    return base.withColumns(
        {
            "in_BBandLower": bollinger_lower("in_BBandMiddle", _DEV),
            "in_BBandUpper": bollinger_upper("in_BBandMiddle", _DEV),
        }
    ).drop(_DEV)


def _stochastic(df: DataFrame, spec: WindowSpec, k_window: int, d_window: int) -> DataFrame:
    ranged = df.withColumns(
        {_HIGH: moving_highest("cuote_high", k_window, spec), _LOW: moving_lowest("cuote_low", k_window, spec)}
    ).withColumn("in_StochLineK", stochastic_k("cuote_close", _HIGH, _LOW))
    return ranged.withColumn("in_StochLineD", moving_average("in_StochLineK", d_window, spec)).drop(_HIGH, _LOW)


def add_rsi(df: DataFrame, window: int, zero_loss: str = "zero", **series) -> DataFrame:
    """Adds `in_RSI` from plain moving averages of gains and losses."""
    return over_series(df, window + 1, lambda d, w: _rsi(d, w, window, zero_loss), **series)


def add_bollinger(df: DataFrame, window: int, **series) -> DataFrame:
    """Adds `in_BBandMiddle`, `in_BBandLower`, `in_BBandUpper`."""
    return over_series(df, window, lambda d, w: _bollinger(d, w, window), **series)


def add_stochastic(df: DataFrame, k_window: int, d_window: int, **series) -> DataFrame:
    """Adds `in_StochLineK` and `in_StochLineD`."""
    return over_series(df, k_window + d_window, lambda d, w: _stochastic(d, w, k_window, d_window), **series)


def add_indicators(
    df: DataFrame,
    rsi_window: int = 14,
    band_window: int = 20,
    k_window: int = 14,
    d_window: int = 3,
    zero_loss: str = "zero",
    **series,
) -> DataFrame:
    """All three over one shuffle and one sort of the bars."""

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        return _stochastic(_bollinger(_rsi(d, w, rsi_window, zero_loss), w, band_window), w, k_window, d_window)

    return over_series(df, max(rsi_window + 1, band_window, k_window + d_window), add, **series)
