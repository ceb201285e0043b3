"""Record layouts, timeframes and where each timeframe is stored."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# Field names, order and types of a bar record in the archives.
CSV_FIELDS = T.StructType(
    [
        T.StructField("cuote_opentime", T.LongType()),
        T.StructField("cuote_open", T.DoubleType()),
        T.StructField("cuote_high", T.DoubleType()),
        T.StructField("cuote_low", T.DoubleType()),
        T.StructField("cuote_close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("cuote_closetime", T.LongType()),
        T.StructField("asset_volume", T.DoubleType()),
        T.StructField("qtde_trades", T.IntegerType()),
        T.StructField("buy_volume", T.DoubleType()),
        T.StructField("buy_asset_volume", T.DoubleType()),
        T.StructField("ignore", T.StringType()),
    ]
)
CORRUPT = "_corrupt_record"
CSV_FIELDS_WITH_CORRUPT = T.StructType(CSV_FIELDS.fields + [T.StructField(CORRUPT, T.StringType())])

RAW_ONLY = ("cuote_opentime", "cuote_closetime")
KEPT_FIELDS = [f for f in CSV_FIELDS.fields if f.name not in RAW_ONLY]

# Timeframe -> stored table.
TABLES = {
    "15m": "binance_daily_hist_m15",
    "30m": "binance_daily_hist_m30",
    "1h": "binance_daily_hist_h1",
    "4h": "binance_daily_hist_h4",
    "1d": "binance_monthly_hist_d1",
    "1w": "binance_monthly_hist_w1",
}
TIMEFRAMES = tuple(TABLES)
DATABASE = "crypto"

# Timeframe -> document collection; the shortest timeframe has none.
COLLECTIONS = {"30m": "crypto.m30", "1h": "crypto.h1", "4h": "crypto.h4", "1d": "crypto.d1", "1w": "crypto.w1"}

# Bar length in minutes.
MINUTES = {"15m": 15, "30m": 30, "1h": 60, "4h": 240, "1d": 1440, "1w": 10080}

DAY_PARTITIONS = ("index", "cuote_date")
MONTH_PARTITIONS = ("index", "cuote_year", "cuote_month")


def table_name(timeframe: str) -> str:
    if timeframe not in TABLES:
        raise ValueError(f"unknown timeframe {timeframe!r}, expected one of {', '.join(TIMEFRAMES)}")
    return TABLES[timeframe]


def collection_name(timeframe: str) -> str:
    if timeframe not in COLLECTIONS:
        raise ValueError(f"no collection for timeframe {timeframe!r}, expected one of {', '.join(COLLECTIONS)}")
    return COLLECTIONS[timeframe]


def table_name_column(timeframe: Column | str) -> Column:
    """The same route as data; NULL for an unknown timeframe."""
    pairs = [F.lit(part) for item in TABLES.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), F.col(timeframe) if isinstance(timeframe, str) else timeframe)


def partition_columns(timeframe: str) -> tuple[str, ...]:
    return MONTH_PARTITIONS if table_name(timeframe).startswith("binance_monthly") else DAY_PARTITIONS


def partition_fields(timeframe: str) -> list[T.StructField]:
    types = {"index": T.StringType(), "cuote_date": T.DateType()}
    return [T.StructField(c, types.get(c, T.IntegerType())) for c in partition_columns(timeframe)]


def stored_schema(timeframe: str) -> T.StructType:
    """Explicit, so that an all-digits symbol never becomes a number on read."""
    return T.StructType(
        KEPT_FIELDS + [T.StructField("cuote_timestamp", T.TimestampType())] + partition_fields(timeframe)
    )


def chunk_days(timeframe: str, rows: int = 8192) -> int:
    """Days of one series that hold about `rows` bars."""
    return max(1, rows * MINUTES[timeframe] // 1440)
