"""Continuous loading of bar files into a store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from candlemill.plans.load import load_accounted
from candlemill.schema import TIMEFRAMES
from candlemill.session import staged
from candlemill.sources.csv_bars import as_bars, bad_rows, named_lines, records_of_lines
from candlemill.sources.store import BarStore

_COUNTS = "batch_id bigint, timeframe string, loaded bigint, dropped bigint, duplicates bigint"
_BATCHES = "batch_id bigint, seen bigint, bad bigint"


def stream_records(store: BarStore, path: str, files_per_batch: int | None = None) -> DataFrame:
    """CSV records as they arrive; same columns as `read_records`."""
    reader = store.spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return records_of_lines(named_lines(reader.text(path)))


def stream_incremental_load(
    store: BarStore,
    records: DataFrame,
    log_path: str,
    checkpoint: str,
    timeframes: Sequence[str] = TIMEFRAMES,
    dedup_within: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Load each batch of records; every record is accounted for below `log_path`.

    `bad` holds records that make no bar, `counts` the bars loaded, dropped and found to be duplicates
    per timeframe (see `load_accounted`; bars of none of the timeframes are dropped as `other`),
    `batches` the records seen and the bad ones. Per batch, seen = bad + loaded + dropped + duplicates.

    A stored bar is never stored twice, since a batch drops bars at or before their symbol's
    mark; so a replayed batch adds nothing, and no state is kept: with `dedup_within` (say "2 days") copies
    of stored bars are told from late ones by looking into the store.
    """
    spark = store.spark

    def load(batch: DataFrame, batch_id: int) -> None:
        def log(rows: list[tuple], schema: str, name: str) -> None:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{log_path}/{name}/batch={batch_id}")

        with staged(batch, "records") as records:
            bad_rows(records).write.mode("overwrite").parquet(f"{log_path}/bad/batch={batch_id}")
            bars = as_bars(records)
            seen, good = records.count(), bars.count()
            with staged(bars, "bars", "timeframe") as known:
                counts = {}
                for timeframe in timeframes:
                    some = known.where(F.col("timeframe") == timeframe)
                    counts[timeframe] = load_accounted(store, some, timeframe, dedup_within, some.select("index").distinct())
                other = known.where(F.col("timeframe").isNull() | ~F.col("timeframe").isin(*timeframes)).count()
        if other:
            counts["other"] = {"loaded": 0, "dropped": other, "duplicates": 0}
        log([(batch_id, t, c["loaded"], c["dropped"], c["duplicates"]) for t, c in counts.items()], _COUNTS, "counts")
        log([(batch_id, seen, seen - good)], _BATCHES, "batches")

    return (
        records.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(load)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
