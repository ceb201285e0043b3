from datetime import datetime, timedelta

from candlemill.operators.bars import bars_from_events, roll_up
from candlemill.schema import TIMEFRAMES
from helpers import START, plan
from pyspark.sql import functions as F


def events(spark, n=3000):
    rows = [(i, START + timedelta(minutes=17 * i), "A" if i % 3 else "B", float((i * 7) % 13)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, ts timestamp, kind string, value double")


def rows(df, *names):
    return sorted(map(str, df.select("index", "timeframe", F.col("cuote_timestamp").cast("string"), *names).collect()))


FIELDS = ["cuote_open", "cuote_high", "cuote_low", "cuote_close", "volume", "qtde_trades"]


def test_rolled_up_equals_each_alone(spark):
    some = events(spark)
    together = bars_from_events(some, "kind", "ts", "value", TIMEFRAMES)
    alone = [bars_from_events(some, "kind", "ts", "value", t) for t in TIMEFRAMES]
    want = sorted(r for df in alone for r in rows(df, *FIELDS))
    assert rows(together, *FIELDS) == want
    assert together.dtypes == alone[0].dtypes


def test_events_are_not_multiplied(spark):
    """Events go into bars as they are; only the shortest bars are spread over the timeframes."""
    text = plan(bars_from_events(events(spark), "kind", "ts", "value", TIMEFRAMES)).split("Generate inline")
    assert len(text) == 2 and "min_by" in text[1] and "partial" in text[1]


def test_rolling_up_twice(spark):
    hourly = bars_from_events(events(spark), "kind", "ts", "value", "1h")
    direct = roll_up(hourly, "1w")
    steps = roll_up(roll_up(hourly, ["4h"]), ["1w"])
    assert rows(direct, *FIELDS, "ignore") == rows(steps, *FIELDS, "ignore")


def test_missing_values_and_times(spark):
    odd = spark.createDataFrame(
        [("A", datetime(2025, 1, 1, 1), None), ("A", datetime(2025, 1, 1, 2), 5.0), ("A", None, 9.0), (None, datetime(2025, 1, 1, 2), 1.0)],
        "kind string, ts timestamp, value double",
    )
    got = {r["index"]: r for r in bars_from_events(odd, "kind", "ts", "value", ["15m", "1d"]).where("timeframe = '1d'").collect()}
    assert (got["A"].cuote_high, got["A"].cuote_close, got["A"].volume, got["A"].qtde_trades) == (5.0, 5.0, 5.0, 2)
    assert got[None].cuote_open == 1.0
    assert bars_from_events(odd.where("false"), "kind", "ts", "value").count() == 0
