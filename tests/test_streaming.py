from datetime import datetime, timedelta

import pytest
from helpers import START, full_bars
from pyspark.sql import functions as F
from test_sources import put

from candlemill.operators.bars import bars_from_events
from candlemill.plans.load import load_incremental
from candlemill.registry.files import write_archives
from candlemill.sources.series_files import SeriesFiles
from candlemill.sources.store import PathStore
from candlemill.streaming.bars import read_bar_updates, stream_bars_from_events, write_bar_updates
from candlemill.streaming.ingest import stream_incremental_load, stream_records
from candlemill.streaming.requests import RequestService, stream_requests


def hourly(spark, closes, index="A", start=START):
    return full_bars(spark, closes, index, start).withColumn("timeframe", F.lit("1h"))


def run_ingest(store, folder, files_per_batch=None, **more):
    records = stream_records(store, f"{folder}/in", files_per_batch)
    stream_incremental_load(store, records, f"{folder}/log", f"{folder}/checkpoint", ["1h"], **more).awaitTermination()


def closes(store, timeframe="1h"):
    return sorted((r["index"], r.cuote_close) for r in store.read(timeframe).collect())


def test_file_by_file_equals_batch_and_restart_adds_nothing(spark, folder):
    store = PathStore(spark, f"{folder}/tables")
    bars = hourly(spark, [float(i) for i in range(60)]).unionByName(hourly(spark, [1.0] * 30, "B"))
    write_archives(bars, f"{folder}/in", "yyyy-MM-dd")
    run_ingest(store, folder)
    batch = PathStore(spark, f"{folder}/batch")
    load_incremental(batch, bars, "1h")
    assert closes(store) == closes(batch)
    run_ingest(store, folder)
    assert closes(store) == closes(batch)
    write_archives(hourly(spark, [7.0, 8.0], "B", START + timedelta(hours=28)), f"{folder}/in", "yyyy-MM")
    run_ingest(store, folder, 1)
    assert closes(store) == sorted([*closes(batch)])
    write_archives(hourly(spark, [9.0], "B", START + timedelta(days=9)), f"{folder}/in", "yyyy-MM-dd")
    run_ingest(store, folder, 1)
    assert closes(store) == sorted([*closes(batch), ("B", 9.0)])
    counts = spark.read.parquet(f"{folder}/log/counts")
    assert counts.agg(F.sum("loaded"), F.sum("dropped")).first() == (91, 2)


def test_bad_records_go_to_the_log(spark, folder):
    store = PathStore(spark, f"{folder}/tables")
    write_archives(hourly(spark, [1.0]), f"{folder}/in", "yyyy-MM")
    put(f"{folder}/in", "A-1h-2025-02.csv", "header,line")
    run_ingest(store, folder)
    assert closes(store) == [("A", 1.0)]
    assert [r._corrupt_record for r in spark.read.parquet(f"{folder}/log/bad").collect()] == ["header,line"]


def test_dedup_in_the_stream(spark, folder):
    store = PathStore(spark, f"{folder}/tables")
    for period in ("yyyy-MM", "yyyy-MM-dd"):
        write_archives(hourly(spark, [1.0, 2.0]), f"{folder}/in", period)
    run_ingest(store, folder, dedup_within="2 days")
    assert closes(store) == [("A", 1.0), ("A", 2.0)]
    assert spark.read.parquet(f"{folder}/log/counts").agg(F.sum("loaded"), F.sum("dropped")).first() == (2, 0)


def test_every_record_is_accounted_for(spark, folder):
    store = PathStore(spark, f"{folder}/tables")
    write_archives(hourly(spark, [1.0] * 6), f"{folder}/in", "yyyy-MM")
    write_archives(hourly(spark, [1.0] * 3), f"{folder}/in", "yyyy-MM-dd")  # copies in the same batch
    run_ingest(store, folder, dedup_within="3 hours")
    write_archives(hourly(spark, [2.0] * 8).withColumn("index", F.lit("A")), f"{folder}/in", None)  # six copies, two new
    write_archives(hourly(spark, [3.0] * 2, start=START - timedelta(hours=5)), f"{folder}/in", "yyyy-MM")  # late
    write_archives(hourly(spark, [4.0]).withColumn("timeframe", F.lit("4h")), f"{folder}/in", None)  # not asked for
    spark.createDataFrame([("open_time,open",), ("x",)], "value string").coalesce(1).write.mode("append").text(f"{folder}/in")
    run_ingest(store, folder, dedup_within="3 hours")
    assert closes(store) == [("A", 1.0)] * 6 + [("A", 2.0)] * 2
    counts = {(r.batch_id, r.timeframe): (r.loaded, r.dropped, r.duplicates) for r in spark.read.parquet(f"{folder}/log/counts").collect()}
    # The mark is 05:00, so stored bars from 02:00 on are duplicates and the two before are dropped.
    assert counts == {(0, "1h"): (6, 0, 3), (1, "1h"): (2, 2 + 2, 4), (1, "other"): (0, 1, 0)}
    batches = {r.batch_id: (r.seen, r.bad) for r in spark.read.parquet(f"{folder}/log/batches").collect()}
    assert batches == {0: (9, 0), 1: (13, 2)}
    assert spark.read.parquet(f"{folder}/log/bad").count() == 2


def service(spark, folder, source, store, **more):
    return RequestService(store, source, f"{folder}/log", ["1h"], **more)


def requests(spark, folder, bars_of, store):
    served = service(spark, folder, lambda symbols, t, _: bars_of(t), store)
    return stream_requests(served, f"{folder}/in", f"{folder}/checkpoint")


def write_requests(spark, folder, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(f"{folder}/in")


def test_requests_are_served_and_rejected(spark, folder):
    store = PathStore(spark, f"{folder}/tables")
    bars = hourly(spark, [1.0, 2.0]).unionByName(hourly(spark, [3.0], "B")).unionByName(hourly(spark, [4.0], "C"))
    write_requests(
        spark, folder,
        '{"symbol":"A","exchange":"binance","priority":1}', '{"symbol":"B","exchange":"binance","priority":5}',
        '{"symbol":"C","exchange":"coinex","priority":1}', '{"symbol":"D"', "",
    )
    requests(spark, folder, lambda t: bars, store).awaitTermination()
    assert closes(store) == [("A", 1.0), ("A", 2.0), ("B", 3.0)]
    accepted = spark.read.parquet(f"{folder}/log/accepted").orderBy("position").collect()
    assert [(r.symbol, r.position) for r in accepted] == [("B", 1), ("A", 2)]
    assert [r.symbol for r in spark.read.parquet(f"{folder}/log/unsupported").collect()] == ["C"]
    assert sorted(r.value for r in spark.read.parquet(f"{folder}/log/rejected").collect()) == ["", '{"symbol":"D"']


def asked(spark, *symbols):
    rows = [(f'{{"symbol":"{s}","exchange":"binance","priority":{9 - i}}}', START) for i, s in enumerate(symbols)]
    return spark.createDataFrame(rows, "value string, arrival timestamp")


def tries(df):
    return sorted((r.symbol, r["round"], r.attempt, r.status) for r in df.collect())


def test_a_failing_symbol_waits_while_others_go_on(spark, folder):
    store, asked_for = PathStore(spark, f"{folder}/tables"), []
    bars = hourly(spark, [1.0]).unionByName(hourly(spark, [2.0], "B")).unionByName(hourly(spark, [3.0], "C"))

    def source(symbols, timeframe, now):
        asked_for.append(symbols)
        broken = F.col("index") == F.lit("B" if now < START + timedelta(hours=1) else "")
        unread = F.when(broken, F.raise_error(F.lit("bad archive")).cast("double")).otherwise(F.col("cuote_close"))
        return bars.where(F.col("index").isin(*symbols)).withColumn("cuote_close", unread)

    served = service(spark, folder, source, store, per_round=2, wait=timedelta(minutes=40))
    first = served.serve(asked(spark, "A", "B", "C"), "0", START)
    assert tries(first) == [("A", 1, 1, "loaded"), ("B", 1, 1, "waiting"), ("C", 2, 1, "loaded")]
    assert closes(store) == [("A", 1.0), ("C", 3.0)]
    assert asked_for == [["A", "B"], ["A"], ["B"], ["C"]]
    assert "bad archive" in first.where("error is not null").first()["error"]
    assert tries(served.retry("1", START + timedelta(minutes=39))) == []
    assert tries(served.retry("2", START + timedelta(minutes=40))) == [("B", 1, 2, "waiting")]
    assert tries(served.serve(asked(spark, "B", "D"), "3", START + timedelta(minutes=70))) == [("B", 1, 3, "loaded"), ("D", 1, 1, "loaded")]
    assert served.waiting().count() == 0 and closes(store) == [("A", 1.0), ("B", 2.0), ("C", 3.0)]


def test_tries_end(spark, folder):
    store = PathStore(spark, f"{folder}/tables")

    def away(symbols, timeframe, now):
        raise OSError("source is away")

    served = service(spark, folder, away, store, most_tries=2, wait=timedelta(minutes=1))
    served.serve(asked(spark, "A"), "0", START)
    again = served.serve(asked(spark, "A"), "0", START)  # the same batch once more: still the first try
    assert tries(again) == [("A", 1, 1, "waiting")] == tries(served.attempts())
    assert tries(served.retry("1", START + timedelta(days=1))) == [("A", 1, 2, "failed")]
    assert tries(served.retry("2", START + timedelta(days=2))) == []


def test_a_failed_source_is_asked_again(spark, folder):
    store = PathStore(spark, f"{folder}/tables")
    write_requests(spark, folder, '{"symbol":"A","exchange":"binance","priority":1}')

    def broken(timeframe):
        raise OSError("source is away")

    requests(spark, folder, broken, store).awaitTermination()
    assert store.read("1h").count() == 0
    served = service(spark, folder, lambda symbols, t, _: hourly(spark, [1.0]), store)
    served.retry("later", datetime.now() + timedelta(hours=1))
    assert closes(store) == [("A", 1.0)]


def test_only_files_of_the_symbols_are_opened(spark, folder):
    names = ["A", "AB", "A-B", "A{1,2}", "A*", "[A]"]
    for name in names:
        put(folder, f"{name}-1h-2025-01.csv", "")
        put(folder, f"{name}-1h.csv", "")
        put(folder, f"{name}-4h.csv", "")
    files = SeriesFiles(spark, folder)
    for name in names:
        assert [p.rsplit("/", 1)[1] for p in files.paths([name], "1h")] == [f"{name}-1h-2025-01.csv", f"{name}-1h.csv"]
    assert len(files.paths(["A", "[A]", "none"], "4h")) == 2
    assert files.paths([], "1h") == files.paths(["none"], "1h") == []
    assert files.bars(["none"], "1h").count() == 0


@pytest.mark.parametrize("timeframe", ["15m", "4h", "1d", "1w"])
def test_streamed_bars_equal_batch(spark, folder, timeframe):
    rows = [(i, START + timedelta(minutes=7 * i), "A" if i % 3 else "B", float((i * 7) % 13)) for i in range(3000)]
    events = spark.createDataFrame(rows, "id int, ts timestamp, kind string, value double")
    for part in range(3):
        events.where(f"id div 1000 = {part}").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        bars = stream_bars_from_events(stream, "kind", "ts", "value", timeframe)
        write_bar_updates(bars, f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    streamed = read_bar_updates(spark, f"{folder}/log")
    batch = bars_from_events(events, "kind", "ts", "value", timeframe)
    assert sorted(map(tuple, streamed.select(batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_late_events_count_unless_a_lateness_is_given(spark, folder):
    rows = [(START + timedelta(hours=h), "A", 1.0) for h in (100, 50, 1)]
    for i, row in enumerate(rows):
        events = spark.createDataFrame([row], "ts timestamp, kind string, value double")
        events.write.mode("append").parquet(f"{folder}/in")
        for name, lateness in (("all", None), ("some", "1 hour")):
            stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
            bars = stream_bars_from_events(stream, "kind", "ts", "value", "1h", lateness)
            write_bar_updates(bars, f"{folder}/{name}", f"{folder}/checkpoint-{name}").awaitTermination()
    assert read_bar_updates(spark, f"{folder}/all").count() == 3
    assert read_bar_updates(spark, f"{folder}/some").count() == 1
