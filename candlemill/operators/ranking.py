"""Order of service for load requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from candlemill.functions.text import MAX_PRIORITY
from candlemill.session import written

_ROW_BITS = 33  # of monotonically_increasing_id: partition above, row in the partition below


def by_priority(requests: DataFrame, arrival: Sequence[str] = ("arrival",)) -> DataFrame:
    """Requests in order of service: higher priority first, then by arrival.

    Priorities below 0 and above 10 rank as 0 and 10; the column keeps what was sent.
    """
    rank = F.greatest(F.lit(0), F.least(F.lit(MAX_PRIORITY), F.col("priority")))
    return requests.orderBy(F.desc(rank), *arrival)


def with_service_position(requests: DataFrame, arrival: Sequence[str] = ("arrival",)) -> DataFrame:
    """Adds `position`, the 1-based place in the order of `by_priority`.

    The sort splits the requests into ranges of about equal size. They are written
    down with their row number within the range, and shifted by the number of rows
    in the ranges before, of which there is one per shuffle partition.
    """
    ordered = by_priority(requests, arrival).withColumn("__id", F.monotonically_increasing_id())
    ordered = written(ordered, "ordered").withColumn("__part", F.shiftright("__id", _ROW_BITS))
    sizes = ordered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    row = F.col("__id") - F.shiftleft("__part", _ROW_BITS)
    placed = ordered.join(F.broadcast(shifts), "__part")  # one row per range
    return placed.withColumn("position", F.col("__shift") + row + 1).drop("__id", "__part", "__shift")
