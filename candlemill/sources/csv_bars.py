"""Bars from CSV files, one per series or one per archive period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlemill.functions.temporal import calendar_columns, epoch_to_timestamp
from candlemill.functions.text import archive_fields, archive_split, url_decoded
from candlemill.schema import CORRUPT, CSV_FIELDS_WITH_CORRUPT, KEPT_FIELDS

_DDL = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CSV_FIELDS_WITH_CORRUPT.fields)


def read_records(spark: SparkSession, path: str | list[str], since_period: str | None = None) -> DataFrame:
    """CSV records with symbol, timeframe and period from the file name.

    With `since_period` (yyyy-MM) Spark opens only archives of that month or
    later; files without a period are always read.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    if since_period is not None:
        period = archive_fields(archive_split("_metadata.file_name"))["period"]
        lines = lines.where(period.isNull() | (F.substring(period, 1, 7) >= since_period))
    return records_of_lines(named_lines(lines))


def named_lines(lines: DataFrame) -> DataFrame:
    """Text lines with the name of their file, batch or stream."""
    return lines.select(F.col("value").alias("line"), url_decoded("_metadata.file_name").alias("file_name"))


def records_of_lines(lines: DataFrame) -> DataFrame:
    """Records of (line, file_name).

    A line that does not fit keeps its text in the corrupt-record column. Every
    line is parsed as a whole: the CSV source would convert only the columns a
    query uses, and so find fewer bad records the fewer columns are asked for.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # inline() keeps later filters above the parser, so a line is parsed once.
    fields = F.inline(F.array(F.from_csv("line", _DDL, options)))
    parsed = lines.where(F.length(F.trim("line")) > 0).select("file_name", fields, archive_split("file_name").alias("__name"))
    return parsed.withColumns(archive_fields("__name")).drop("__name")


def is_bad(index: str | None = None, timeframe: str | None = None) -> Column:
    """A record that makes no bar; without symbol or timeframe in the file's name, unless they are given."""
    bad = F.col("cuote_opentime").isNull() | F.col(CORRUPT).isNotNull()
    for name, given in (("index", index), ("timeframe", timeframe)):
        bad = bad if given is not None else bad | F.col(name).isNull()
    return bad


def bad_rows(records: DataFrame, index: str | None = None, timeframe: str | None = None) -> DataFrame:
    """Records kept out of the bars, with file name and `reason`: header lines, bad fields, short
    rows, no open time (`record`), or no symbol or timeframe in the file's name (`name`)."""
    unreadable = is_bad("", "")
    return records.where(is_bad(index, timeframe)).withColumn("reason", F.when(unreadable, "record").otherwise("name"))


def as_bars(records: DataFrame, index: str | None = None, timeframe: str | None = None) -> DataFrame:
    """Clean records as bars with timestamp and calendar columns.

    `index` and `timeframe` override what the file name says.
    """
    bars = records.where(~is_bad(index, timeframe)).withColumn("cuote_timestamp", epoch_to_timestamp("cuote_opentime"))
    if index is not None:
        bars = bars.withColumn("index", F.lit(index))
    if timeframe is not None:
        bars = bars.withColumn("timeframe", F.lit(timeframe))
    return bars.withColumns(calendar_columns()).select(
        *[f.name for f in KEPT_FIELDS],
        "cuote_timestamp",
        "index",
        "cuote_date",
        "cuote_year",
        "cuote_month",
        "timeframe",
        "period",
    )


def read_bars(
    spark: SparkSession,
    path: str | list[str],
    index: str | None = None,
    timeframe: str | None = None,
    since_period: str | None = None,
) -> DataFrame:
    """All bars below `path`: one series file, a folder of series, or a folder of archives."""
    return as_bars(read_records(spark, path, since_period), index, timeframe)


def last_timestamps(records: DataFrame) -> DataFrame:
    """Newest bar time per series of the records, by the same unit rule as the bars."""
    newest = F.max(epoch_to_timestamp("cuote_opentime")).alias("last_timestamp")
    return records.where(F.col("cuote_opentime").isNotNull()).groupBy("index", "timeframe").agg(newest)
