from datetime import datetime

import pytest
from pyspark.sql import functions as F

from candlemill.functions import scalar, temporal, text
from candlemill.functions.sql import register_functions
from candlemill.sources import catalogue
from candlemill.schema import chunk_days, partition_columns, table_name


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def num(x):
    return F.lit(x).cast("double")


@pytest.mark.parametrize(
    "n, d, expected", [(6, 3, 2.0), (5, -2, 0.0), (5, 0, 0.0), (None, 2, None), (1, None, None), (1, float("nan"), 0.0)]
)
def test_division(spark, n, d, expected):
    assert value(spark, scalar.safe_division(num(n), num(d))) == expected


@pytest.mark.parametrize(
    "x, up, down", [(2.5, 2.5, 0.0), (-2.5, 0.0, 2.5), (0, 0.0, 0.0), (None, None, None), (float("nan"), 0.0, 0.0)]
)
def test_gain_and_loss(spark, x, up, down):
    assert value(spark, scalar.gain(num(x))) == up
    assert value(spark, scalar.loss(num(x))) == down


def test_rsi_formula(spark):
    assert value(spark, scalar.rsi_from_ratio(num(-1))) == 0.0
    assert value(spark, scalar.rsi_from_ratio(num(1))) == 50.0
    assert value(spark, scalar.rsi_from_ratio(num(None))) is None
    with pytest.raises(ValueError):
        scalar.rsi_from_averages(num(1), num(1), "other")


def test_stochastic_and_bands(spark):
    assert value(spark, scalar.stochastic_k(num(2), num(4), num(0))) == 50.0
    assert value(spark, scalar.stochastic_k(num(2), num(2), num(2))) == 0.0
    assert value(spark, scalar.bollinger_lower(num(10), num(2))) == 6.0
    assert value(spark, scalar.bollinger_upper(num(10), num(2))) == 14.0
    assert value(spark, scalar.bollinger_upper(num(10), num(None))) is None


def test_sql_functions_equal_columns(spark):
    register_functions(spark)
    rows = [(float(n), float(d)) for n in (-2, 0, 3) for d in (-1, 0, 2)] + [(None, 1.0), (float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "n double, d double").selectExpr(
        "n", "d", "bar_division(n, d) a", "bar_gain(n) b", "bar_loss(n) c", "bar_rsi(d) e",
        "bar_stochastic_k(n, d, 0D) f", "bar_band_lower(n, d) g", "bar_band_upper(n, d) h",
    )
    columns = {
        "a": scalar.safe_division("n", "d"), "b": scalar.gain("n"), "c": scalar.loss("n"),
        "e": scalar.rsi_from_ratio("d"), "f": scalar.stochastic_k("n", "d", F.lit(0.0)),
        "g": scalar.bollinger_lower("n", "d"), "h": scalar.bollinger_upper("n", "d"),
    }
    differing = [c for c, made in columns.items() if df.where(~F.col(c).eqNullSafe(made)).count()]
    assert differing == []


@pytest.mark.parametrize(
    "opentime, expected",
    [
        (9999999999999, datetime(2286, 11, 20, 17, 46, 39)),
        (10000000000000, datetime(1970, 4, 26, 17, 46, 40)),
        (1735689600123456, datetime(2025, 1, 1)),
        (1735689600123, datetime(2025, 1, 1)),
        (None, None),
    ],
)
def test_epoch(spark, opentime, expected):
    stamp = temporal.epoch_to_timestamp(F.lit(opentime).cast("long")).cast("timestamp_ntz")
    assert value(spark, stamp) == expected


@pytest.mark.parametrize(
    "timeframe, expected",
    [
        ("15m", datetime(2025, 3, 5, 13, 45)), ("30m", datetime(2025, 3, 5, 13, 30)), ("1h", datetime(2025, 3, 5, 13)),
        ("4h", datetime(2025, 3, 5, 12)), ("1d", datetime(2025, 3, 5)), ("1w", datetime(2025, 3, 3)),
    ],
)
def test_bar_start(spark, timeframe, expected):
    stamp = F.lit("2025-03-05 13:59:59.9").cast("timestamp")
    assert value(spark, temporal.bar_start(stamp, timeframe).cast("timestamp_ntz")) == expected


def test_partition_strings(spark):
    day, month = F.lit("index=BTC-X/cuote_date=2025-03-01"), F.lit("index=BTC-X/cuote_year=2025/cuote_month=3")
    assert str(value(spark, text.partition_date(day))) == "2025-03-01"
    assert value(spark, text.partition_date(month)) is None
    assert value(spark, text.partition_year_month(month)) == 202503
    assert value(spark, text.partition_year_month(F.lit("index=B/cuote_year=2025/cuote_month=11"))) == 202511
    assert value(spark, text.partition_symbol(month)) == "BTC-X"
    assert value(spark, text.partition_date(F.lit("index=B/cuote_date=__HIVE_DEFAULT_PARTITION__"))) is None


def test_archive_names(spark):
    def parts(name):
        return tuple(value(spark, c) for c in text.archive_fields(text.archive_split(F.lit(name))).values())

    assert parts("BTCUSDT-1h.csv") == ("BTCUSDT", "1h", None)
    assert parts("A-B-15m-2025-01.zip") == ("A-B", "15m", "2025-01")
    assert parts("BTCUSDT-1d-2025-01-31.csv") == ("BTCUSDT", "1d", "2025-01-31")
    assert parts("other.csv") == (None, None, None)
    assert value(spark, text.url_decoded(F.lit("A%20B+C-1h.csv"))) == "A B+C-1h.csv"


@pytest.mark.parametrize(
    "payload, expected",
    [
        ('{"symbol":"A","exchange":"binance","priority":3}', ("A", "binance", 3, True)),
        ('{"symbol":"A","exchange":"binance","priority":"7"}', ("A", "binance", 7, True)),
        ('{"symbol":"A","exchange":"binance","priority":99}', ("A", "binance", 99, True)),
        ('{"symbol":"A","priority":3}', ("A", None, 3, False)),
        ('{"symbol":"A","exchange":"b","priority":"x"}', ("A", "b", None, False)),
    ],
)
def test_requests(spark, payload, expected):
    raw = spark.createDataFrame([(payload,)], "value string")
    row = catalogue.parse_requests(raw).first()
    assert (row.symbol, row.exchange, row.priority, row.valid) == expected


@pytest.mark.parametrize("payload", ["", "no json", '{"symbol":"A', None])
def test_unreadable_requests(spark, payload):
    rows = catalogue.parse_requests(spark.createDataFrame([(payload,)], "value string")).collect()
    assert [(r.value, r.valid) for r in rows] == [(payload, False)]


def test_routes():
    assert table_name("15m") == "binance_daily_hist_m15"
    assert partition_columns("1w") == ("index", "cuote_year", "cuote_month")
    assert partition_columns("4h") == ("index", "cuote_date")
    assert chunk_days("15m") == 85
    with pytest.raises(ValueError):
        table_name("2h")
