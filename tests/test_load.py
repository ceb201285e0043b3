import uuid
from datetime import date, datetime, timedelta

import pytest
from helpers import START, full_bars, plan
from pyspark.sql import functions as F

from candlemill.operators.dedup import dedup_bars, latest_row, upsert_replace
from candlemill.operators.marks import latest_partition_year_month, newer_than_marks
from candlemill.operators.ranking import by_priority, with_service_position
from candlemill.plans.backfill import backfill_plan
from candlemill.plans.compact import compact_partitions
from candlemill.plans.load import (
    drop_symbols,
    full_reload,
    load_all_timeframes,
    load_incremental,
    replace_by_key,
)
from candlemill.sources.store import CatalogStore, PathStore

DAY = timedelta(days=1)


@pytest.fixture(params=["path", "catalog"])
def store(request, spark, folder):
    if request.param == "path":
        return PathStore(spark, folder)
    return CatalogStore(spark, f"db_{uuid.uuid4().hex}", folder)


def content(store, timeframe="1h"):
    rows = store.read(timeframe).select("index", F.col("cuote_timestamp").cast("string"), "cuote_close").collect()
    return sorted(map(tuple, rows))


def test_loading_twice_is_loading_once(spark, store):
    bars = full_bars(spark, [1.0, 2.0, 3.0]).unionByName(full_bars(spark, [4.0], "B"))
    assert load_incremental(store, bars, "1h") == {"loaded": 4, "dropped": 0}
    before = content(store)
    assert load_incremental(store, bars, "1h") == {"loaded": 0, "dropped": 4}
    assert content(store) == before and len(before) == 4


def test_late_bars_are_dropped_per_symbol(spark, store):
    load_incremental(store, full_bars(spark, [1.0, 2.0], start=START + DAY), "1h")
    more = full_bars(spark, [9.0], start=START).unionByName(full_bars(spark, [5.0], "B"))
    more = more.unionByName(full_bars(spark, [3.0], start=START + 3 * DAY))
    assert load_incremental(store, more, "1h") == {"loaded": 2, "dropped": 1}
    assert [c for *_, c in content(store)] == [1.0, 2.0, 3.0, 5.0]


def test_marks_of_some_symbols(spark, store):
    load_incremental(store, full_bars(spark, [1.0, 2.0]).unionByName(full_bars(spark, [4.0], "B")), "1h")
    wanted = spark.createDataFrame([("B",), ("C",)], "`index` string")
    assert [r["index"] for r in store.marks("1h", wanted).collect()] == ["B"]
    assert load_incremental(store, full_bars(spark, [4.0, 5.0], "B"), "1h", wanted) == {"loaded": 1, "dropped": 1}


def test_bars_of_other_symbols_are_not_loaded(spark, store):
    bars = full_bars(spark, [1.0, 2.0]).unionByName(full_bars(spark, [4.0], "B"))
    wanted = spark.createDataFrame([("B",), ("B",)], "`index` string")
    assert load_incremental(store, bars, "1h", wanted) == {"loaded": 1, "dropped": 0}
    assert load_incremental(store, bars, "1h", wanted) == {"loaded": 0, "dropped": 1}
    assert [c for *_, c in content(store)] == [4.0]


def test_bars_without_symbol_or_time_are_never_loaded(spark, store):
    bars = full_bars(spark, [1.0, 2.0])
    bars = bars.unionByName(bars.withColumn("index", F.lit(None).cast("string")))
    bars = bars.unionByName(full_bars(spark, [3.0], "B").withColumn("cuote_timestamp", F.lit(None).cast("timestamp")))
    assert load_incremental(store, bars, "1h") == {"loaded": 2, "dropped": 3}
    assert load_incremental(store, bars, "1h") == {"loaded": 0, "dropped": 5}
    assert [c for *_, c in content(store)] == [1.0, 2.0]


def test_empty_input(spark, store):
    assert load_incremental(store, full_bars(spark, [1.0]).where("false"), "1h") == {"loaded": 0, "dropped": 0}
    load_incremental(store, full_bars(spark, [1.0]), "1h")
    assert load_incremental(store, full_bars(spark, [1.0]).where("false"), "1h") == {"loaded": 0, "dropped": 0}


def test_copies_in_a_batch(spark, store):
    monthly = full_bars(spark, [1.0, 2.0]).withColumn("period", F.lit("2025-01"))
    daily = full_bars(spark, [7.0]).withColumn("period", F.lit("2025-01-01"))
    load_incremental(store, monthly.unionByName(daily), "1h")
    assert [c for *_, c in content(store)] == [7.0, 2.0]


def test_newest_month_is_by_number(spark, store):
    for month in (11, 3, 9):
        store.append("1d", full_bars(spark, [float(month)], start=datetime(2024, month, 5)).withColumns(
            {"cuote_year": F.lit(2024), "cuote_month": F.lit(month)}))
    assert [tuple(r) for r in store.newest_partitions("1d").collect()] == [("A", 2024, 11)]
    assert [r.cuote_close for r in store.read_last_partitions("1d").collect()] == [11.0]
    assert load_incremental(store, full_bars(spark, [1.0], start=datetime(2024, 11, 5)), "1d")["dropped"] == 1


def test_only_month_three(spark, store):
    load_incremental(store, full_bars(spark, [1.0], start=datetime(2024, 3, 5)), "1d")
    assert [tuple(r) for r in store.newest_partitions("1d").collect()] == [("A", 2024, 3)]
    assert load_incremental(store, full_bars(spark, [1.0], start=datetime(2024, 3, 5)), "1d")["loaded"] == 0


def test_default_partition_is_no_date(spark):
    rows = spark.createDataFrame([("A", 2024, 3), ("A", None, None), ("B", None, None)], "`index` string, cuote_year int, cuote_month int")
    assert [tuple(r) for r in latest_partition_year_month(rows).collect()] == [("A", 2024, 3)]


def test_numeric_symbol_stays_text(spark, store):
    load_incremental(store, full_bars(spark, [1.0], "0123"), "1h")
    assert store.read("1h").first()["index"] == "0123"
    assert load_incremental(store, full_bars(spark, [1.0], "0123"), "1h")["loaded"] == 0
    assert store.read_market("0123", "1h").count() == 1


def test_nothing_stored_yet(spark, store):
    assert store.read("4h").count() == 0
    assert store.partitions("4h").count() == 0
    assert store.marks("4h").count() == 0
    assert store.inventory().count() == 0
    drop_symbols(store, "4h", ["A"])


def test_full_reload_removes_old_partitions(spark, store):
    old = full_bars(spark, [float(i) for i in range(60)]).unionByName(full_bars(spark, [8.0], "B"))
    load_incremental(store, old, "1h")
    full_reload(store, full_bars(spark, [1.5, 2.5], start=START + DAY), "1h")
    assert [(i, c) for i, _, c in content(store)] == [("A", 1.5), ("A", 2.5), ("B", 8.0)]


def test_reload_equals_two_loads(spark, store, folder):
    first, second = full_bars(spark, [1.0, 2.0]), full_bars(spark, [3.0, 4.0], start=START + DAY)
    load_incremental(store, first, "1h")
    load_incremental(store, first.unionByName(second), "1h")
    other = PathStore(spark, f"{folder}/other")
    full_reload(other, first.unionByName(second), "1h")
    assert content(store) == content(other)


def test_drop_symbol(spark, store):
    load_incremental(store, full_bars(spark, [1.0] * 30).unionByName(full_bars(spark, [8.0], "it's")), "1h")
    drop_symbols(store, "1h", ["A"])
    assert [i for i, *_ in content(store)] == ["it's"]
    drop_symbols(store, "1h", ["it's"])
    assert content(store) == []


def test_replace_by_key_moves_rows(spark, store):
    load_incremental(store, full_bars(spark, [1.0, 2.0, 3.0], step=DAY), "1h")
    changed = full_bars(spark, [20.0, 40.0], start=START + DAY, step=2 * DAY)
    replace_by_key(store, changed, "1h")
    assert [c for *_, c in content(store)] == [1.0, 20.0, 3.0, 40.0]
    # keyed by symbol alone, a later bar takes the place of all earlier ones
    replace_by_key(store, full_bars(spark, [9.0], start=START + 9 * DAY), "1h", ["index"])
    assert [c for *_, c in content(store)] == [9.0]
    assert [str(r.cuote_date) for r in store.partitions("1h").collect()] == ["2025-01-10"]


def test_compaction(spark, folder):
    store = PathStore(spark, folder)
    for hour in range(3):
        load_incremental(store, full_bars(spark, [float(hour)], start=START + timedelta(hours=hour)), "1h")
    load_incremental(store, full_bars(spark, [5.0], "B"), "1h")
    before = content(store)
    assert store.files("1h").count() == 4
    assert compact_partitions(store, "1h") == 1
    assert store.files("1h").count() == 2 and content(store) == before
    assert compact_partitions(store, "1h") == 0


@pytest.mark.parametrize("remove", [False, True])
def test_compaction_of_catalogue_tables(spark, folder, remove):
    store = CatalogStore(spark, f"db_{uuid.uuid4().hex}", folder)
    assert compact_partitions(store, "1h") == 0
    for hour in range(3):
        load_incremental(store, full_bars(spark, [float(hour)], "A:B %'+", start=START + timedelta(hours=hour)), "1h")
    load_incremental(store, full_bars(spark, [5.0], "B"), "1h")
    before, counts = content(store), lambda: sorted(r.files for r in store.file_counts("1h").collect())
    reader = store.read("1h")
    files = reader.inputFiles()
    assert counts() == [1, 3]
    assert compact_partitions(store, "1h", remove_replaced=remove) == 1
    assert counts() == [1, 1] and content(store) == before
    assert compact_partitions(store, "1h") == 0
    left = [f for f in files if _exists(spark, f)]
    assert len(left) == (1 if remove else 4)
    # later loads, replacements and drops follow the partitions to their new place
    load_incremental(store, full_bars(spark, [7.0], "A:B %'+", start=START + timedelta(hours=3)), "1h")
    assert counts() == [1, 2] and len(content(store)) == 5
    assert compact_partitions(store, "1h", remove_replaced=remove) == 1 and len(content(store)) == 5
    store.overwrite_partitions("1h", store.spark.createDataFrame(store.read("1h").where("cuote_close > 1").collect(), store.read("1h").schema))
    assert counts() == [1, 1] and sorted(r[2] for r in content(store)) == [2.0, 5.0, 7.0]
    drop_symbols(store, "1h", ["A:B %'+"])
    assert [r[0] for r in content(store)] == ["B"]


def _exists(spark, url):
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(url))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_all_timeframes(spark, folder):
    store = PathStore(spark, folder)
    bars = full_bars(spark, [1.0, 2.0]).withColumn("timeframe", F.explode(F.array(F.lit("1h"), F.lit("1w"))))
    counts = load_all_timeframes(store, bars)
    assert {t: c["loaded"] for t, c in counts.items() if c["loaded"]} == {"1h": 2, "1w": 2}
    inventory = {r.table: (r.partitions, r.newest) for r in store.inventory().collect()}
    assert inventory == {"binance_daily_hist_h1": (1, "2025-01-01"), "binance_monthly_hist_w1": (1, "2025-01")}


def test_partition_filters(spark, store):
    load_incremental(store, full_bars(spark, [1.0] * 60), "1h")
    one = plan(store.read_market("A", "1h"))
    assert "PartitionFilters: [isnotnull(index" in one
    last = store.read_last_partitions("1h")
    assert ">= 2025-01-03" in plan(last) and "dynamicpruning" in plan(last)
    assert {str(r.cuote_date) for r in last.select("cuote_date").collect()} == {"2025-01-03"}


def test_listing_opens_no_file(spark, folder):
    store = PathStore(spark, folder)
    load_incremental(store, full_bars(spark, [1.0] * 60), "1h")
    assert "FileScan binaryFile" in plan(store.newest_partitions("1h"))
    assert "parquet" not in plan(store.newest_partitions("1h")).lower().replace("*.parquet", "")


def test_newer_than_marks(spark):
    bars = full_bars(spark, [1.0, 2.0, 3.0]).unionByName(full_bars(spark, [4.0], "B"))
    marks = spark.createDataFrame([("A", START + timedelta(hours=1))], "`index` string, mark timestamp")
    assert sorted(r.cuote_close for r in newer_than_marks(bars, marks).collect()) == [3.0, 4.0]


def test_dedup_is_deterministic(spark):
    rows = [("A", "1h", START, "2025-01", 1.0), ("A", "1h", START, "2025-01-01", 2.0), ("A", "1h", START, None, 3.0)]
    df = spark.createDataFrame(rows, "`index` string, timeframe string, cuote_timestamp timestamp, period string, v double")
    assert [r.v for r in dedup_bars(df).collect()] == [2.0]
    tied = df.withColumn("period", F.lit("p"))
    assert [r.v for r in dedup_bars(tied.orderBy(F.desc("v"))).collect()] == [3.0]
    assert [r.v for r in dedup_bars(tied.orderBy("v")).collect()] == [3.0]


def test_latest_row(spark):
    bars = full_bars(spark, [1.0, 2.0]).unionByName(full_bars(spark, [4.0], "B"))
    assert sorted(r.cuote_close for r in latest_row(bars).collect()) == [2.0, 4.0]
    assert latest_row(bars.where("false")).count() == 0


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "_id int, v string")
    updates = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z")], "_id int, v string")
    assert sorted(map(tuple, upsert_replace(target, updates, prefer="v").collect())) == [(1, "a"), (2, "y"), (3, "z")]


def test_service_order(spark):
    rows = [(i, (i % 4) * 4 - 1, START + timedelta(seconds=i // 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, priority int, arrival timestamp").repartition(7)
    expected = [r[0] for r in sorted(rows, key=lambda r: (-min(max(r[1], 0), 10), r[2], r[0]))]
    placed = with_service_position(df, ["arrival", "id"]).orderBy("position").collect()
    assert [r.id for r in placed] == expected and [r.position for r in placed] == list(range(1, 201))
    assert [r.id for r in by_priority(df, ["arrival", "id"]).collect()] == expected


def periods(spark, last, timeframe="1h", start="2025-01-01", end="2025-03-05", today="2025-03-05", manifest=None):
    series = spark.createDataFrame([("A", timeframe, last)], "`index` string, timeframe string, last_timestamp timestamp")
    rows = backfill_plan(series, start, end, today, manifest).collect()
    return sorted(r.period for r in rows)


MARCH = [f"2025-03-0{d}" for d in range(1, 6)]


def test_backfill_of_a_new_series(spark):
    assert periods(spark, None) == ["2025-01", "2025-02", *MARCH]
    assert periods(spark, None, start="2025-03-02") == MARCH
    assert periods(spark, None, end="2025-02-10") == ["2025-01", "2025-02"]
    assert periods(spark, None, "1w") == ["2025-01", "2025-02"]
    manifest = spark.createDataFrame([("A-1h-2025-01.zip",), ("A-1h-2025-03-01.zip",)], "file_name string")
    assert periods(spark, None, manifest=manifest) == ["2025-02", *MARCH[1:]]


def test_backfill_of_a_loaded_series(spark):
    assert periods(spark, datetime(2025, 3, 3, 23)) == ["2025-03-04", "2025-03-05"]
    assert periods(spark, datetime(2025, 3, 5, 23)) == []
    assert periods(spark, datetime(2025, 1, 31, 23)) == ["2025-02", *MARCH]
    assert periods(spark, datetime(2025, 1, 29, 23)) == ["2025-01-30", "2025-01-31", "2025-02", *MARCH]
    assert periods(spark, datetime(2025, 1, 13), "1w") == ["2025-01", "2025-02"]
    assert periods(spark, datetime(2025, 3, 2), end="2025-02-10") == []
    assert str(date(2025, 3, 5)) == MARCH[-1]
