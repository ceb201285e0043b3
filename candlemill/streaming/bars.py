"""Bars from a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from candlemill.operators.bars import as_bar, ohlcv
from candlemill.operators.dedup import dedup_bars
from candlemill.schema import MINUTES

_BATCH = "batch"
_KEYS = ["index", "timeframe", "cuote_timestamp"]


def stream_bars_from_events(
    events: DataFrame, index: str, ts: str, value: str, timeframe: str, lateness: str | None = None
) -> DataFrame:
    """Streaming twin of `bars_from_events`.

    Every event counts, however late: state then holds one row per bar. With
    `lateness` Spark forgets bars older than that, and drops events that come later still.
    """
    length = f"{MINUTES[timeframe]} minutes"
    offset = "4 days" if timeframe == "1w" else "0 minutes"  # 1970-01-05 was a Monday
    rows = events.select(
        F.col(index).cast("string").alias("index"),
        F.col(ts).cast("timestamp").alias("ts"),
        F.col(value).alias("value"),
    )
    if lateness is not None:
        rows = rows.withWatermark("ts", lateness)
    bars = rows.groupBy("index", F.window("ts", length, length, offset).alias("w")).agg(
        *ohlcv(F.col("ts"), F.col("value"))
    )
    return as_bar(bars.withColumns({"timeframe": F.lit(timeframe), "cuote_timestamp": F.col("w.start")}))


def write_bar_updates(bars: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append every change of a bar to a log, one folder per batch.

    A batch that runs again overwrites its own folder, so a replay changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{_BATCH}={batch_id}")

    return (
        bars.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_bar_updates(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of every bar in the log."""
    return dedup_bars(spark.read.parquet(path), _KEYS, _BATCH).drop(_BATCH)
