"""Collections: footers, marks of late symbols, replacing by key."""

from datetime import datetime, timedelta

import pytest
from candlemill.plans import load
from candlemill.sources.collection import Collection, CollectionStore
from helpers import START, full_bars, plan


@pytest.fixture
def store(spark, folder):
    return CollectionStore(spark, folder)


def stored(store, timeframe="1h"):
    return sorted((r["index"], r["cuote_timestamp"], r["cuote_close"]) for r in store.read(timeframe).collect())


def paths(collection):
    return {r[0] for r in collection.read().select("_metadata.file_path").distinct().collect()}


def test_newest_comes_from_footers(spark, store):
    assert store.newest("1h") is None
    store.append("1h", full_bars(spark, [1.0, 2.0, 3.0]))
    footers = store.collection("1h").footers("cuote_micros")
    assert "PushedAggregation: [COUNT(*), MAX(cuote_micros)]" in plan(footers)
    assert footers.first()["n"] == 3
    assert store.newest("1h") == START + timedelta(hours=2)


def test_incremental(spark, store):
    first = full_bars(spark, [1.0, 2.0])
    assert load.load_collection(store, first, "1h") == {"loaded": 2, "dropped": 0}
    assert load.load_collection(store, first, "1h") == {"loaded": 0, "dropped": 2}
    assert load.load_collection(store, full_bars(spark, [9.0, 9.0, 3.0]), "1h") == {"loaded": 1, "dropped": 2}
    assert [c for *_, c in stored(store)] == [1.0, 2.0, 3.0]


def test_newer_bars_read_no_stored_row(spark, store, monkeypatch):
    load.load_collection(store, full_bars(spark, [1.0, 2.0]), "1h")
    monkeypatch.setattr(CollectionStore, "marks", lambda *_, **__: pytest.fail("marks were read"))
    later = full_bars(spark, [5.0], index="B", start=START + timedelta(days=1))
    assert load.load_collection(store, later, "1h") == {"loaded": 1, "dropped": 0}


def test_symbols_behind_the_newest_of_all(spark, store):
    load.load_collection(store, full_bars(spark, [1.0] * 48), "1h")
    load.load_collection(store, full_bars(spark, [1.0], index="C"), "1h")
    more = full_bars(spark, [2.0] * 3, index="B").unionByName(full_bars(spark, [3.0] * 3, index="C"))
    more = more.unionByName(full_bars(spark, [4.0], start=START + timedelta(hours=47)))
    assert load.load_collection(store, more, "1h") == {"loaded": 5, "dropped": 2}
    got = stored(store)
    assert len([r for r in got if r[0] == "B"]) == 3 and [r[2] for r in got if r[0] == "C"] == [1.0, 3.0, 3.0]


def test_marks_push_their_bound(spark, store):
    store.append("1h", full_bars(spark, [1.0, 2.0]))
    marks = store.marks("1h", since=datetime(2025, 1, 1, 1))
    assert "GreaterThanOrEqual(cuote_timestamp" in plan(marks)
    assert [tuple(r) for r in marks.collect()] == [("A", START + timedelta(hours=1))]
    assert store.marks("1h", since=datetime(2026, 1, 1)).count() == 0
    assert "EqualTo(index,A)" in plan(store.read_market("A", "1h"))


def test_bars_without_symbol_or_time(spark, store):
    bars = full_bars(spark, [1.0, 2.0])
    odd = bars.unionByName(bars.selectExpr("* except (`index`)", "cast(null as string) as `index`"))
    odd = odd.unionByName(bars.selectExpr("* except (cuote_timestamp)", "cast(null as timestamp) as cuote_timestamp"))
    assert load.load_collection(store, odd, "1h") == {"loaded": 2, "dropped": 4}
    assert load.load_collection(store, odd, "4h", replace=True) == {"loaded": 2, "dropped": 4}
    assert load.load_collection(store, odd.where("false"), "1h") == {"loaded": 0, "dropped": 0}
    assert len(stored(store)) == len(stored(store, "4h")) == 2


def test_replacing_bars(spark, store):
    load.load_collection(store, full_bars(spark, [1.0, 2.0]), "1h")
    assert load.load_collection(store, full_bars(spark, [7.0, 8.0, 9.0]), "1h", replace=True) == {"loaded": 3, "dropped": 0}
    assert [c for *_, c in stored(store)] == [7.0, 8.0, 9.0]


def test_no_collection_for_the_shortest_timeframe(store):
    with pytest.raises(ValueError, match="15m"):
        store.read("15m")


def documents(spark, rows):
    return spark.createDataFrame(rows, "_id long, status string, v int")


def test_replace_rewrites_only_files_with_the_keys(spark, folder):
    collection = Collection(spark, f"{folder}/assets", documents(spark, []).schema)
    for first in (0, 10, 20):
        collection.append(documents(spark, [(first + i, "open", 0) for i in range(3)]).coalesce(1))
    before = paths(collection)
    collection.replace(documents(spark, [(11, "closed", 1), (11, "closed", 2), (99, "open", 1)]), "_id", "v")
    rows = {r["_id"]: (r["status"], r["v"]) for r in collection.read().collect()}
    assert len(rows) == collection.read().count() == 10
    assert rows[11] == ("closed", 2) and rows[99] == ("open", 1) and rows[10] == ("open", 0)
    assert len(before & paths(collection)) == 2


def test_replace_mends_a_run_that_ended_early(spark, folder):
    collection = Collection(spark, f"{folder}/assets", documents(spark, []).schema)
    collection.replace(documents(spark, [(1, "open", 0), (1, "open", 3)]), prefer="v")
    collection.append(documents(spark, [(1, "closed", 4)]))  # new files in place, the old not yet gone
    collection.replace(documents(spark, [(1, "closed", 4)]))
    assert [tuple(r) for r in collection.read().collect()] == [(1, "closed", 4)]


def test_extra_columns_are_left_out(spark, folder):
    collection = Collection(spark, f"{folder}/assets", documents(spark, []).schema, ["_id"])
    collection.append(documents(spark, [(2, None, None), (None, "x", 1)]).selectExpr("*", "1 as __file"))
    collection.replace(documents(spark, [(2, "open", None), (None, "y", 1)]).selectExpr("*", "1 as other"))
    assert sorted((r["_id"] or 0, r["status"]) for r in collection.read().collect()) == [(0, "x"), (0, "y"), (2, "open")]
