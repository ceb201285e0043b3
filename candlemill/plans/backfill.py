"""Which archive periods of each series are still to be fetched."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from candlemill.functions.text import archive_fields, archive_split


def _day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def _steps(first: Column, last: Column, unit: str) -> Column:
    """Array of dates, empty when the range is."""
    return F.when(first <= last, F.sequence(first, last, F.expr(f"interval 1 {unit}"))).otherwise(_no_dates())


def _no_dates() -> Column:
    return F.array().cast("array<date>")


def _as(kind: str, days: Column) -> Column:
    return F.transform(days, lambda d: F.struct(F.lit(kind).alias("kind"), d.alias("day")))


def backfill_plan(
    series: DataFrame,
    start: date | str,
    end: date | str,
    today: date | str,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """One row per archive still needed: index, timeframe, kind, period, file_name.

    `series` has index, timeframe and last_timestamp, NULL for a series never
    loaded. Months without any loaded bar come as monthly archives up to the last
    complete month, the rest as daily ones. `1w` exists as monthly archives only,
    so there a month begun is fetched again. Names in `manifest.file_name` are
    already there and left out.
    """
    month = lambda d: F.trunc(d, "month").cast("date")
    end_day, this_month = _day(end), month(_day(today))
    last_month = F.when(month(end_day) == this_month, F.add_months(this_month, -1)).otherwise(month(end_day))
    loaded = F.col("last_timestamp").isNotNull()
    weekly = F.col("timeframe") == "1w"

    cursor = F.when(loaded, F.date_add(F.to_date("last_timestamp"), 1)).otherwise(_day(start))
    begun = loaded & ~weekly & (cursor > month(cursor))
    first_month = F.when(begun, F.add_months(month(cursor), 1)).otherwise(month(cursor))
    rest_of_begun_month = F.least(F.last_day(cursor), end_day)
    has_rest = begun & (month(cursor) <= last_month)
    first_open_day = F.when(loaded, F.greatest(cursor, F.add_months(last_month, 1))).otherwise(this_month)

    months = _steps(first_month, last_month, "month")
    rest = F.when(has_rest, _steps(cursor, rest_of_begun_month, "day")).otherwise(_no_dates())
    open_days = F.when(this_month <= end_day, _steps(first_open_day, end_day, "day")).otherwise(_no_dates())
    days = F.when(weekly, _no_dates()).otherwise(F.concat(rest, open_days))
    if manifest is not None:
        # Per series, before the periods become rows: the arrays are bounded by the calendar.
        series = series.join(_at_hand(manifest), ["index", "timeframe"], "left")
        months = F.array_except(months, F.coalesce("months_at_hand", _no_dates()))
        days = F.array_except(days, F.coalesce("days_at_hand", _no_dates()))
    # A series is one small row here and up to hundreds below; spread the rows, not their bytes.
    tasks = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    series = series.repartition(tasks, "index", "timeframe")
    needed = series.select("index", "timeframe", F.inline(F.concat(_as("monthly", months), _as("daily", days))))
    day = F.col("day").cast("string")
    period = F.when(F.col("kind") == "monthly", F.substring(day, 1, len("yyyy-MM"))).otherwise(day)
    plan = needed.select("index", "timeframe", "kind", period.alias("period"))
    return plan.withColumn("file_name", F.concat(F.concat_ws("-", "index", "timeframe", "period"), F.lit(".zip")))


def _at_hand(manifest: DataFrame) -> DataFrame:
    """Archives already there, as sets of months and of days per series."""
    names = manifest.select(archive_split("file_name").alias("name"))
    parts = names.select(*[c.alias(k) for k, c in archive_fields("name").items()]).where(F.col("period").isNotNull())
    monthly = F.length("period") == len("yyyy-MM")
    first_day = F.concat("period", F.lit("-01"))
    return parts.groupBy("index", "timeframe").agg(
        F.collect_set(F.when(monthly, first_day).cast("date")).alias("months_at_hand"),
        F.collect_set(F.when(~monthly, F.col("period")).cast("date")).alias("days_at_hand"),
    )
