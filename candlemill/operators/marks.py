"""High-water marks and newest partitions, for all symbols at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MARK = "mark"


def high_water_mark(
    bars: DataFrame, partition_cols: Sequence[str] = ("index",), order_col: str = "cuote_timestamp"
) -> DataFrame:
    """Newest time per series; an absent series has no row."""
    return bars.groupBy(*partition_cols).agg(F.max(order_col).alias(MARK))


def latest_partition_date(partitions: DataFrame) -> DataFrame:
    """Newest `cuote_date` per symbol; the default (NULL) partition is no date."""
    real = partitions.where(F.col("cuote_date") >= F.lit("0001-01-01").cast("date"))
    return real.groupBy("index").agg(F.max("cuote_date").alias("cuote_date"))


def latest_partition_year_month(partitions: DataFrame) -> DataFrame:
    """Newest year and month per symbol."""
    real = partitions.where((F.col("cuote_year") >= 1) & (F.col("cuote_month") >= 1))
    newest = real.groupBy("index").agg(F.max(F.col("cuote_year") * 100 + F.col("cuote_month")).alias("ym"))
    return newest.select(
        "index",
        F.floor(F.col("ym") / 100).cast("int").alias("cuote_year"),
        (F.col("ym") % 100).cast("int").alias("cuote_month"),
    )


def is_newer(order_col: str = "cuote_timestamp") -> Column:
    return F.col(MARK).isNull() | (F.col(order_col) > F.col(MARK))


def with_marks(bars: DataFrame, marks: DataFrame, partition_cols: Sequence[str] = ("index",)) -> DataFrame:
    """Bars with the mark of their series, NULL where nothing is stored.

    The marks hold one row per symbol. No hint is given: Spark broadcasts them
    when their measured size allows it and otherwise joins by shuffle, where its
    skew handling splits a hot symbol on the bars' side.
    """
    return bars.join(marks, list(partition_cols), "left")


def newer_than_marks(
    bars: DataFrame,
    marks: DataFrame,
    partition_cols: Sequence[str] = ("index",),
    order_col: str = "cuote_timestamp",
) -> DataFrame:
    """Bars strictly newer than the mark of their series; all bars of a new series."""
    return with_marks(bars, marks, partition_cols).where(is_newer(order_col)).drop(MARK)
