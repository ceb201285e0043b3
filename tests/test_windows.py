import random

import pandas as pd
import pytest
from helpers import frame, full_bars, in_order, plan, series, stages
from pyspark.sql import functions as F

from candlemill.operators import indicators, moving
from candlemill.operators.ema import add_ema
from candlemill.registry.files import event_bars

HOUR = 1 / 24


def test_first_row(spark):
    bars = series(spark, [5.0])
    assert in_order(moving.add_price_change(bars, "cuote_close"), "in_change") == [0.0]
    assert in_order(moving.add_moving_stddev(bars, "cuote_close", 5), "in_dev_pad") == [None]
    bands = indicators.add_bollinger(bars, 5)
    assert in_order(bands, "in_BBandMiddle", "in_BBandLower", "in_BBandUpper") == [(5.0, None, None)]
    assert in_order(indicators.add_rsi(bars, 5), "in_RSI") == [0.0]


def test_rising_and_falling(spark):
    up, down = series(spark, [1.0, 2.0, 3.0, 4.0]), series(spark, [4.0, 3.0, 2.0, 1.0])
    assert in_order(indicators.add_rsi(up, 3), "in_RSI") == [0.0] * 4
    assert in_order(indicators.add_rsi(up, 3, "textbook"), "in_RSI") == [0.0, 100.0, 100.0, 100.0]
    assert in_order(indicators.add_rsi(down, 3), "in_RSI") == [0.0] * 4


def test_mixed_rsi(spark):
    assert in_order(indicators.add_rsi(series(spark, [10.0, 12.0, 11.0]), 2), "in_RSI")[2] == pytest.approx(66.666667)


def test_flat_range(spark):
    df = indicators.add_stochastic(series(spark, [3.0, 3.0, 3.0]), 2, 2)
    assert in_order(df, "in_StochLineK", "in_StochLineD") == [(0.0, 0.0)] * 3


def test_frame_holds_window_plus_one_rows(spark):
    df = moving.add_moving_average(series(spark, [1.0, 2.0, 3.0, 4.0]), "cuote_close", 2)
    assert in_order(df, "in_MA") == [1.0, 1.5, 2.0, 3.0]


def test_column_functions_use_the_plain_window(spark):
    df = series(spark, [1.0, 5.0, 3.0]).withColumn("v", moving.moving_highest("cuote_close", 1))
    assert in_order(df, "v") == [1.0, 5.0, 5.0]


def test_interleaved_symbols_and_shuffled_input(spark):
    closes = [float((i * 37) % 11) for i in range(60)]
    a, b = series(spark, closes, "A", spread=1.0), series(spark, closes[::-1], "B", spread=1.0)
    together = frame(indicators.add_indicators(a.unionByName(b).orderBy(F.rand(3)).repartition(5)))
    apart = frame(indicators.add_indicators(a).unionByName(indicators.add_indicators(b)))
    pd.testing.assert_frame_equal(together, apart, check_exact=True)


def sparse(spark):
    """Series with long gaps, so that many chunks hold fewer rows than a frame."""
    rng = random.Random(7)
    bars = series(spark, [float(rng.randint(1, 50)) for _ in range(500)], spread=2.0)
    kept = (F.hour("cuote_timestamp") < 3) | (F.dayofmonth("cuote_timestamp").between(8, 12))
    return bars.where(kept).unionByName(series(spark, [float(i % 9) for i in range(200)], "B", spread=1.0))


@pytest.mark.parametrize("chunk_days", [HOUR, 5 * HOUR, 1, 7, 90])
def test_split_equals_plain(spark, chunk_days):
    bars = sparse(spark)
    plain = frame(indicators.add_indicators(bars, chunk_days=None))
    split = frame(indicators.add_indicators(bars, chunk_days=chunk_days))
    pd.testing.assert_frame_equal(plain, split, check_exact=True)


def test_split_by_clock_time(spark):
    bars = sparse(spark).withColumn("cuote_timestamp", F.col("cuote_timestamp").cast("timestamp_ntz"))
    plain = frame(indicators.add_rsi(bars, 14, chunk_days=None))
    pd.testing.assert_frame_equal(plain, frame(indicators.add_rsi(bars, 14, chunk_days=HOUR * 6)), check_exact=True)


def test_bounds(spark, sf_dir):
    df = indicators.add_indicators(event_bars(spark, sf_dir))
    outside = (
        ~F.col("in_RSI").between(0, 100) | ~F.col("in_StochLineK").between(0, 100)
        | (F.col("in_BBandLower") > F.col("in_BBandMiddle")) | (F.col("in_BBandUpper") < F.col("in_BBandMiddle"))
    )
    assert df.where(outside).count() == 0


def test_null_close(spark):
    df = indicators.add_rsi(series(spark, [1.0, None, 3.0, 2.0, 4.0]), 2)
    assert df.count() == 5
    assert in_order(indicators.add_bollinger(series(spark, [None, 2.0]), 2), "in_BBandMiddle") == [None, 2.0]


def test_plans_have_no_python_and_share_the_shuffle(spark, sf_dir):
    df = indicators.add_indicators(full_bars(spark, [float(i) for i in range(50)]))
    df.collect()
    final = plan(df)
    assert "Python" not in final and "ReusedExchange" in final
    assert "Python" not in plan(add_ema(event_bars(spark, sf_dir), 5))


def pandas_ema(bars, span):
    return frame(bars).groupby("index")["cuote_close"].transform(lambda s: s.ewm(span=span, adjust=False).mean())


def test_ema_small(spark):
    assert in_order(add_ema(series(spark, [1.0, 2.0, 3.0]), 3), "in_EMA") == [1.0, 1.5, 2.25]
    with pytest.raises(ValueError):
        add_ema(series(spark, [1.0]), 0.5)


@pytest.mark.parametrize("span", [1, 1.2, 3, 14, 400])
@pytest.mark.parametrize("chunk_days", [HOUR * 3, 2, 90])
def test_ema_equals_pandas(spark, span, chunk_days):
    bars = sparse(spark)
    got = frame(add_ema(bars, span, chunk_days=chunk_days))["in_EMA"]
    pd.testing.assert_series_equal(got, pandas_ema(bars, span), check_names=False, rtol=1e-10)


@pytest.mark.parametrize("chunk_days", [HOUR * 3, 2, 90])
def test_ema_with_missing_values(spark, chunk_days):
    missing = F.hour("cuote_timestamp").isin(0, 1, 2, 3, 13, 20) | F.dayofmonth("cuote_timestamp").isin(1, 9, 10)
    close = F.when(~missing, F.col("cuote_close")).when(F.hour("cuote_timestamp") == 13, F.lit(float("nan")))
    bars = sparse(spark).withColumn("cuote_close", close)
    got = frame(add_ema(bars, 6, chunk_days=chunk_days))["in_EMA"]
    pd.testing.assert_series_equal(got, pandas_ema(bars, 6), check_names=False, rtol=1e-10)


def test_ema_over_many_blocks(spark):
    """One chunk far longer than a block of decay."""
    from datetime import timedelta

    rng = random.Random(1)
    bars = series(spark, [rng.uniform(-5, 5) for _ in range(4000)], step=timedelta(minutes=1))
    for span in (2, 9):
        got = frame(add_ema(bars, span))["in_EMA"]
        pd.testing.assert_series_equal(got, pandas_ema(bars, span), check_names=False, rtol=1e-8, atol=1e-9)


def test_no_task_holds_a_whole_series(spark):
    """Windows over all rows are hashed by chunk; what is hashed by series alone is a seam or one row per chunk."""
    bars = full_bars(spark, [float(i % 17) for i in range(4000)])
    df = indicators.add_rsi(bars, 14, chunk_days=30)
    df.collect()
    widths = {}
    for node in stages(df._jdf.queryExecution().executedPlan()):
        by_chunk = "__chunk" in node.outputPartitioning().toString()
        rows = node.getRuntimeStatistics().rowCount().get()
        widths[by_chunk] = max(widths.get(by_chunk, 0), rows)
    assert widths == {True: 4000, False: 2 * 15 * 7}  # the 4000 hours touch seven spans of 30 days


def test_ema_reads_and_shuffles_bars_once(spark, folder):
    """Also when the chunk starts are too many to broadcast."""
    full_bars(spark, [float(i % 17) for i in range(500)]).write.parquet(f"{folder}/bars")
    bars = spark.read.parquet(f"{folder}/bars")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    for size in (before, "-1"):
        spark.conf.set(threshold, size)
        try:
            df = add_ema(bars, 5, chunk_days=2)
            df.collect()
            ran = plan(df).split("== Initial Plan ==")[0]
            assert ran.count("ReusedExchange") == 1 and ran.count("FileScan") == 1, ran
            ran_stages = [s for s in stages(df._jdf.queryExecution().executedPlan()) if "Reused" not in s.plan().toString().split("\n")[0]]
            by_chunk = [s for s in ran_stages if "__chunk" in s.outputPartitioning().toString()]
            rows = sorted(s.getRuntimeStatistics().rowCount().get() for s in by_chunk)
            assert rows == ([500] if size == before else [11, 500])  # the bars, and the starts of eleven chunks
            got = frame(df)["in_EMA"]
        finally:
            spark.conf.set(threshold, before)
        pd.testing.assert_series_equal(got, pandas_ema(bars, 5), check_names=False, rtol=1e-10)


def test_ema_holds_no_array(spark):
    assert "array" not in plan(add_ema(full_bars(spark, [1.0, 2.0]), 5)).lower()
