"""What is listed and read when only some symbols or partitions are asked for."""

from datetime import timedelta

import pytest
from candlemill.plans import load
from candlemill.sources import store as stores
from candlemill.sources.store import CatalogStore, PathStore
from helpers import START, full_bars, plan
from pyspark.sql import functions as F

ODD = ["A", "A B", "A*", "{A,B}", "A=1", "[A]%2F", "Ä"]


@pytest.fixture
def store(spark, folder):
    store = PathStore(spark, f"{folder}/tables")
    bars = full_bars(spark, [float(i) for i in range(60)], ODD[0])
    for name in ODD[1:]:
        bars = bars.unionByName(full_bars(spark, [1.0, 2.0], name))
    load.load_incremental(store, bars, "1h")
    return store


def test_only_the_folder_of_a_symbol_is_listed(spark, store):
    for name in ODD:
        market = store.read_market(name, "1h")
        assert {r["index"] for r in market.collect()} == {name}
        assert len(store.folders("1h", [name, "none"])) == 1
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        assert f"InMemoryFileIndex(1 paths)[file:{store.location('1h')}/index=A]" in plan(store.read_market("A", "1h"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert store.read_market("none", "1h").count() == 0
    assert store.read_market("A", "4h").count() == 0
    assert store.read_market("A", "1h").columns == store.read("1h").columns


def test_marks_of_some_symbols(spark, store, monkeypatch):
    some = spark.createDataFrame([("A",), ("{A,B}",), ("none",), (None,)], "index string")
    want = [("A", START + timedelta(hours=59)), ("{A,B}", START + timedelta(hours=1))]
    assert sorted(tuple(r) for r in store.marks("1h", some).collect()) == want
    asked = []
    monkeypatch.setattr(PathStore, "folders", lambda *a: asked.append(a[2]) or [])
    monkeypatch.setattr(stores, "_NAMED_SYMBOLS", 3)
    assert sorted(tuple(r) for r in store.marks("1h", some).collect()) == want  # too many to list one by one
    assert asked == []


def test_catalogue_partitions_of_some_symbols(spark, folder):
    store = CatalogStore(spark, "pruned", f"{folder}/catalogue")
    load.load_incremental(store, full_bars(spark, [1.0] * 30).unionByName(full_bars(spark, [1.0], "B=1")), "1h")
    assert [r["index"] for r in store.partitions("1h", ["B=1"]).collect()] == ["B=1"]
    assert store.partitions("1h").count() == 3


def test_replacing_reads_only_partitions_of_the_updates(spark, store, monkeypatch):
    update = full_bars(spark, [-1.0], "A", START + timedelta(hours=30)).withColumn("seen", F.lit(1))
    read, seen = PathStore.read_partitions, []

    def spied(self, timeframe, partitions):
        out = read(self, timeframe, partitions)
        seen.append((plan(out), {r[0] for r in out.select("cuote_date").distinct().collect()}))
        return out

    monkeypatch.setattr(PathStore, "read_partitions", spied)
    load.replace_by_key(store, update, "1h")
    (text, days), day = seen[0], (START + timedelta(days=1)).date()
    assert days == {day} and len(seen) == 1
    assert "cuote_date#" in text.split("PartitionFilters: [")[1] and f">= {day}" in text and f"<= {day}" in text
    closes = {r.cuote_timestamp: r.cuote_close for r in store.read_market("A", "1h").collect()}
    assert len(closes) == 60 and closes[START + timedelta(hours=30)] == -1.0 and closes[START] == 0.0


def test_replacing_by_another_key_moves_rows(spark, store):
    """The trade count as a key says nothing about the partition: the table is searched."""
    before = store.read("1h").count()
    row = full_bars(spark, [5.0], "A", START + timedelta(days=9)).withColumn("cuote_open", F.lit(59.0))
    load.replace_by_key(store, row, "1h", ["index", "cuote_open"])
    rows = store.read_market("A", "1h").where("cuote_open = 59").collect()
    assert [r.cuote_timestamp for r in rows] == [START + timedelta(days=9)] and store.read("1h").count() == before


def test_dropping_symbols_by_their_folders(store, monkeypatch):
    monkeypatch.setattr(PathStore, "files", lambda *_: pytest.fail("the table was listed"))
    load.drop_symbols(store, "1h", ["A", "{A,B}", "none"])
    assert {r["index"] for r in store.read("1h").select("index").distinct().collect()} == set(ODD) - {"A", "{A,B}"}
    load.drop_symbols(store, "4h", ["A"])
