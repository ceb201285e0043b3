"""Bars made from a table of events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from candlemill.functions.temporal import bar_start
from candlemill.schema import KEPT_FIELDS, MINUTES, TIMEFRAMES


def ohlcv(ts: Column, value: Column) -> list[Column]:
    """Aggregates of one bar; all are combined before the shuffle."""
    return [
        F.min_by(value, ts).alias("cuote_open"),
        F.max(value).alias("cuote_high"),
        F.min(value).alias("cuote_low"),
        F.max_by(value, ts).alias("cuote_close"),
        F.sum(value).alias("volume"),
        F.count(F.lit(1)).cast("int").alias("qtde_trades"),
    ]


def as_bar(aggregated: DataFrame) -> DataFrame:
    """The stored field order; fields that events do not have are zero."""
    zeros = {"asset_volume": F.lit(0.0), "buy_volume": F.lit(0.0), "buy_asset_volume": F.lit(0.0), "ignore": F.lit("0")}
    fields = [f.name for f in KEPT_FIELDS]
    return aggregated.withColumns(zeros).select("index", "timeframe", "cuote_timestamp", *fields)


def bars_from_events(
    df: DataFrame,
    index: str,
    ts: str,
    value: str,
    timeframes: str | Sequence[str] = TIMEFRAMES,
    tiebreak: str | None = None,
) -> DataFrame:
    """OHLCV bars per (index, timeframe).

    Events are combined to bars of the shortest timeframe, before the shuffle, so a hot index costs no
    more than its number of bars; the longer timeframes are rolled up from these. `tiebreak`
    orders events of equal time.
    """
    timeframes = [timeframes] if isinstance(timeframes, str) else list(timeframes)
    shortest = min(timeframes, key=MINUTES.__getitem__)
    order = F.col("ts") if tiebreak is None else F.struct("ts", "tie")
    picked = [F.col(index).cast("string").alias("index"), F.col(ts).alias("ts"), F.col(value).alias("value")]
    if tiebreak is not None:
        picked.append(F.col(tiebreak).alias("tie"))
    rows = df.select(*picked).where(F.col("ts").isNotNull()).withColumn("cuote_timestamp", bar_start("ts", shortest))
    bars = rows.groupBy("index", "cuote_timestamp").agg(*ohlcv(order, F.col("value")))
    if len(timeframes) == 1:
        return as_bar(bars.withColumn("timeframe", F.lit(shortest)))
    return as_bar(roll_up(bars, timeframes, [c for c in bars.columns if c not in ("index", "cuote_timestamp")]))


_FROM_SHORTER = {
    "cuote_open": lambda c: F.min_by(c, "cuote_timestamp"),
    "cuote_high": F.max,
    "cuote_low": F.min,
    "cuote_close": lambda c: F.max_by(c, "cuote_timestamp"),
    "qtde_trades": lambda c: F.sum(c).cast("int"),
    "ignore": lambda c: F.max_by(c, "cuote_timestamp"),
}


def roll_up(
    bars: DataFrame, timeframes: str | Sequence[str], fields: Sequence[str] = tuple(f.name for f in KEPT_FIELDS)
) -> DataFrame:
    """Bars of longer timeframes from shorter ones of one timeframe: index, timeframe, cuote_timestamp and `fields`.

    Every timeframe divides the longer ones, so a bar is made of whole shorter bars: the first's
    open, the last's close, the extremes, and sums of the volumes and trades. Bars without time are left out.
    """
    timeframes = [timeframes] if isinstance(timeframes, str) else list(timeframes)
    starts = F.array(
        *[F.struct(F.lit(t).alias("timeframe"), bar_start("cuote_timestamp", t).alias("__start")) for t in timeframes]
    )
    rows = bars.where(F.col("cuote_timestamp").isNotNull()).select("index", "cuote_timestamp", *fields, F.inline(starts))
    merged = [_FROM_SHORTER.get(c, F.sum)(c).alias(c) for c in fields]
    rolled = rows.groupBy("index", "timeframe", F.col("__start").alias("cuote_timestamp_")).agg(*merged)
    return rolled.withColumnRenamed("cuote_timestamp_", "cuote_timestamp")
