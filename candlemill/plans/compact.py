"""Fewer, larger files."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlemill.schema import partition_columns
from candlemill.session import written
from candlemill.sources.store import BarStore


def compact_partitions(store: BarStore, timeframe: str, max_files: int = 1, remove_replaced: bool = False) -> int:
    """Rewrite the partitions of more than `max_files` files; returns their number.

    Only those are read. In a `PathStore` a dynamic overwrite swaps each partition when its new files are
    complete. In a `CatalogStore` the new files lie in a folder of their own, and each partition is then
    pointed to it: readers see the old files or the new ones, never a gap. The old files stay for those
    that still read them; with `remove_replaced` they go, each partition's after its change.
    """
    keys = list(partition_columns(timeframe))
    if not store.exists(timeframe):
        return 0
    crowded = written(store.file_counts(timeframe).where(F.col("files") > max_files).select(*keys), "crowded")
    number = crowded.count()
    if number:
        store.rewrite_partitions(timeframe, crowded, remove_replaced)
    return number
