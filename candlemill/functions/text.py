"""Strings the loaders meet: partition names, file names, requests, asset ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Partition directory names; months are written with one or two digits.
DATE_PARTITION = r"^index=([^/]+)/cuote_date=(\d{4}-\d{2}-\d{2})$"
MONTH_PARTITION = r"^index=([^/]+)/cuote_year=(\d{4})/cuote_month=(\d{1,2})$"

# Fixed value: <symbol>-<timeframe>[-<yyyy-MM>|-<yyyy-MM-dd>].<csv|zip>
ARCHIVE_NAME = r"^(.+)-(15m|30m|1h|4h|1d|1w)(?:-(\d{4}-\d{2}(?:-\d{2})?))?\.(?:csv|zip)$"

MAX_PRIORITY = 10
REQUEST_SCHEMA = "symbol string, exchange string, priority string, _corrupt_record string"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _group(text: Column, pattern: str, group: int) -> Column:
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found)


def partition_symbol(name: Column | str) -> Column:
    name = _col(name)
    return F.coalesce(_group(name, DATE_PARTITION, 1), _group(name, MONTH_PARTITION, 1))


def partition_date(name: Column | str) -> Column:
    """`index=X/cuote_date=D` -> D, else NULL."""
    return _group(_col(name), DATE_PARTITION, 2).cast("date")


def partition_year_month(name: Column | str) -> Column:
    """`index=X/cuote_year=Y/cuote_month=M` -> Y * 100 + M, else NULL."""
    name = _col(name)
    year = _group(name, MONTH_PARTITION, 2).cast("int")
    month = _group(name, MONTH_PARTITION, 3).cast("int")
    return year * 100 + month


def archive_split(file_name: Column | str) -> Column:
    """[symbol, timeframe, period] of an archive name, by one match of the pattern."""
    return F.split(F.regexp_replace(_col(file_name), F.lit(ARCHIVE_NAME), F.lit("$1/$2/$3")), "/")


def archive_fields(split: Column | str) -> dict[str, Column]:
    """Symbol, timeframe and period; NULL where the name has none or is no archive name."""
    split = _col(split)
    found = F.size(split) == 3
    period = F.when(found & (split[2] != ""), split[2])
    return {"index": F.when(found, split[0]), "timeframe": F.when(found, split[1]), "period": period}


def url_decoded(name: Column | str) -> Column:
    """File metadata and partition names come with %XX escapes, but with a plain plus sign."""
    return F.url_decode(F.replace(_col(name), F.lit("+"), F.lit("%2B")))


def exchange_of(asset_id: Column | str) -> Column:
    """Text before the first underscore."""
    return F.split_part(_col(asset_id), F.lit("_"), F.lit(1))


def request_fields(symbol: Column, exchange: Column, priority: Column, corrupt: Column) -> dict[str, Column]:
    """Checked fields of a decoded request: priority as the number that was sent, and `valid`."""
    number = priority.try_cast("int")
    known = symbol.isNotNull() & exchange.isNotNull() & number.isNotNull()
    return {
        "priority": number,
        "valid": known & corrupt.isNull(),
    }


def request_payload(symbol: Column | str, exchange: Column | str, priority: Column | str) -> Column:
    """The JSON text of a load request."""
    return F.to_json(
        F.struct(
            _col(symbol).alias("symbol"), _col(exchange).alias("exchange"), _col(priority).cast("int").alias("priority")
        )
    )
