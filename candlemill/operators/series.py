"""Row windows over series of any length.

A window partitioned by the series alone puts a whole series into one task. Here
each series is cut by calendar into chunks, and windows run per (series, chunk).
A frame looks back over a known number of rows (`lookback`), so only the first
`lookback` rows of a chunk need rows of earlier chunks. Those rows ("heads") are
computed a second time on the seam: the heads and the last `lookback` rows
("tails") of every chunk. The rows before a head are the same in the seam as in
the series, also when a chunk holds fewer rows than the lookback, since such a
chunk lies in the seam as a whole. So the result equals the plain window.

The seam of a series has at most 2 * lookback rows per chunk: its size depends on
the calendar span of the series, not on the number of rows. Both branches read the
same shuffle of the input, which is hashed by (series, chunk).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F
from pyspark.sql import types as T

SERIES = ("index",)
ORDER = "cuote_timestamp"
CHUNK_DAYS = 90

_CHUNK, _RANK, _FOLLOWED = "__chunk", "__rank", "__followed"


def series_window(partition_cols: Sequence[str] = SERIES, order_col: str = ORDER) -> WindowSpec:
    """The plain window of a series, for callers that build their own columns."""
    return Window.partitionBy(*partition_cols).orderBy(order_col)


def preceding(window: int, spec: WindowSpec | None = None) -> WindowSpec:
    """Frame of the current row and `window` rows before it (window + 1 rows)."""
    return (spec if spec is not None else series_window()).rowsBetween(-window, 0)


def calendar_chunk(df: DataFrame, order_col: str, days: float) -> Column:
    """Number of the span of `days` that a row falls into; never falls as time rises."""
    if isinstance(df.schema[order_col].dataType, T.TimestampType):
        seconds = F.unix_seconds(order_col)
    else:  # without zone, so by the clock alone
        day = F.datediff(F.to_date(order_col), F.lit("1970-01-01").cast("date"))
        seconds = day.cast("long") * 86400 + F.hour(order_col) * 3600 + F.minute(order_col) * 60
    return F.floor(seconds / int(86400 * days)).cast("long")


def over_series(
    df: DataFrame,
    lookback: int,
    add_columns: Callable[[DataFrame, WindowSpec], DataFrame],
    partition_cols: Sequence[str] = SERIES,
    order_col: str = ORDER,
    chunk_days: float | None = CHUNK_DAYS,
) -> DataFrame:
    """Apply `add_columns(df, window)` to every series.

    `lookback` is the total reach in rows of the frames that `add_columns` stacks.
    (series, order_col) has to be unique; see `dedup_bars`. `chunk_days=None`
    gives the plain window: one task per series.
    """
    if chunk_days is None:
        return add_columns(df, series_window(partition_cols, order_col))

    within = Window.partitionBy(*partition_cols, _CHUNK).orderBy(order_col)
    ranked = df.withColumn(_CHUNK, calendar_chunk(df, order_col, chunk_days)).withColumns(
        {_RANK: F.row_number().over(within), _FOLLOWED: F.lead(F.lit(1), lookback).over(within)}
    )
    is_head = F.col(_RANK) <= lookback
    is_tail = F.col(_FOLLOWED).isNull()

    bodies = add_columns(ranked, within).where(~is_head)
    heads = add_columns(ranked.where(is_head | is_tail), series_window(partition_cols, order_col)).where(is_head)
    return bodies.unionByName(heads).drop(_CHUNK, _RANK, _FOLLOWED)
