import os
import zipfile

from helpers import full_bars, plan
from pyspark.sql import functions as F

from candlemill.registry.files import write_archives
from candlemill.schema import CORRUPT
from candlemill.session import local_path
from candlemill.sources import archives, catalogue, csv_bars
from candlemill.sources.store import read_table

GOOD = "1735689600123456,1.0,2.0,0.5,1.5,10.0,1735693199999999,5.0,7,1.0,1.0,0"


def put(folder, name, *lines):
    path = os.path.join(local_path(folder), name)
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")


def test_csv_scan(spark, folder):
    put(folder, "BTC-1h.csv", GOOD)
    row = csv_bars.read_bars(spark, folder).withColumn("t", F.col("cuote_timestamp").cast("string")).first()
    assert (row["index"], row.timeframe, row.period, row.t) == ("BTC", "1h", None, "2025-01-01 00:00:00")
    assert (row.cuote_close, row.qtde_trades, row.ignore) == (1.5, 7, "0")
    assert (str(row.cuote_date), row.cuote_year, row.cuote_month) == ("2025-01-01", 2025, 1)
    assert "cuote_opentime" not in row.asDict()
    named = csv_bars.read_bars(spark, folder, index="X", timeframe="4h").first()
    assert (named["index"], named.timeframe) == ("X", "4h")


def test_records_of_unnamed_files_are_bad(spark, folder):
    put(folder, "btc.csv", GOOD, "x")
    records = csv_bars.read_records(spark, folder)
    bad = sorted((r.file_name, r.reason) for r in csv_bars.bad_rows(records).collect())
    assert bad == [("btc.csv", "name"), ("btc.csv", "record")]
    assert csv_bars.as_bars(records).count() == 0
    assert csv_bars.as_bars(records, "BTC", "1h").count() == 1 == csv_bars.bad_rows(records, "BTC", "1h").count()


def test_unreadable_archives_are_bad_rows(spark, folder):
    put(folder, "A-1d-2025-01.zip", "not a zip")
    for name, member in (("B-1d-2025-01", "B.csv"), ("C-1d-2025-01", "C.txt")):
        with zipfile.ZipFile(os.path.join(local_path(folder), f"{name}.zip"), "w") as out:
            out.writestr(member, GOOD + "\n")
    records = archives.read_zip_records(spark, folder)
    bad = sorted((r.file_name, r.reason) for r in csv_bars.bad_rows(records).collect())
    assert bad == [("A-1d-2025-01.zip", "record"), ("C-1d-2025-01.zip", "record")]
    assert [r["index"] for r in csv_bars.as_bars(records).collect()] == ["B"]


def test_table_with_a_schema_keeps_number_like_symbols(spark, folder):
    spark.createDataFrame([("0123", 1.0)], "`index` string, v double").write.partitionBy("index").parquet(f"{folder}/t")
    assert read_table(spark, f"{folder}/t", schema="v double, `index` string").first()["index"] == "0123"


def test_bad_rows_whatever_the_columns(spark, folder):
    put(folder, "BTC-1h.csv", "open_time,open", GOOD, "bad" + GOOD[16:], GOOD.replace("10.0", "ten"), "1735689600123456,1.0", "," + GOOD[17:])
    records = csv_bars.read_records(spark, folder)
    assert csv_bars.bad_rows(records).count() == 5
    assert csv_bars.bad_rows(records).where(F.col(CORRUPT).isNotNull()).count() >= 4
    bars = csv_bars.read_bars(spark, folder)
    assert bars.count() == 1
    assert bars.select("cuote_close").count() == 1
    assert len(bars.select("index").collect()) == 1


def test_archive_names_with_spaces_and_signs(spark, folder):
    put(folder, "A B+C-15m-2025-01.csv", GOOD)
    assert csv_bars.read_bars(spark, folder).first()["index"] == "A B+C"


def test_since_period_opens_fewer_files(spark, folder):
    for month in ("2024-11", "2024-12", "2025-01"):
        put(folder, f"BTC-1h-{month}.csv", GOOD)
    put(folder, "BTC-1h-2025-01-02.csv", GOOD)
    put(folder, "ETH-1h.csv", GOOD)
    df = csv_bars.read_bars(spark, folder, since_period="2025-01")
    assert sorted(df.select(F.coalesce("period", F.lit("-"))).toPandas().iloc[:, 0]) == ["-", "2025-01", "2025-01-02"]
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numFiles").get().value() == 3


def test_zip_scan(spark, folder):
    with zipfile.ZipFile(os.path.join(local_path(folder), "BTC-1d-2025-01.zip"), "w") as out:
        out.writestr("BTC-1d-2025-01.csv", GOOD + "\r\n\r\nbad\n" + GOOD)
        out.writestr("README.txt", "no bars")
    records = archives.read_zip_records(spark, folder)
    assert csv_bars.bad_rows(records).count() == 1
    rows = csv_bars.as_bars(records).collect()
    assert [(r["index"], r.timeframe, r.period, r.ignore) for r in rows] == [("BTC", "1d", "2025-01", "0")] * 2
    assert archives.read_zip_records(spark, folder, since_period="2025-02").count() == 0


def test_files_read_back_equal(spark, folder):
    bars = full_bars(spark, [1.0, 2.0, 3.0]).withColumn("timeframe", F.lit("1h"))
    columns = ["index", "timeframe", "cuote_timestamp", "cuote_close", "volume"]
    for kind in ("csv", "zip"):
        write_archives(bars, f"{folder}/{kind}", "yyyy-MM", kind)
    read = csv_bars.read_bars(spark, f"{folder}/csv")
    unzipped = csv_bars.as_bars(archives.read_zip_records(spark, f"{folder}/zip"))
    expected = sorted(map(tuple, bars.select(columns).collect()))
    assert sorted(map(tuple, read.select(columns).collect())) == expected
    assert sorted(map(tuple, unzipped.select(columns).collect())) == expected


def test_last_timestamps_use_one_unit_rule(spark, folder):
    put(folder, "A-1h.csv", GOOD, GOOD.replace("1735689600123456", "1735693200000000"))
    put(folder, "B-1h.csv", GOOD.replace("1735689600123456", "1735689600000"))
    rows = csv_bars.last_timestamps(csv_bars.read_records(spark, folder)).withColumn("t", F.col("last_timestamp").cast("string"))
    assert {r["index"]: r.t for r in rows.collect()} == {"A": "2025-01-01 01:00:00", "B": "2025-01-01 00:00:00"}


def test_assets_and_routes(spark, folder):
    assets = spark.createDataFrame([("binance_x_y", "A"), ("coinex", "B")], "id string, symbol string")
    assert [r.exchange for r in catalogue.asset_catalog(assets).orderBy("symbol").collect()] == ["binance", "coinex"]
    put(folder, "list.json", '[{"id": "binance_x_y", "symbol": "A"},', ' {"id": "coinex", "symbol": "B"}]')
    listed = catalogue.read_assets(spark, folder, one_document=True)
    assert sorted(map(tuple, listed.collect())) == [("binance_x_y", "A", "binance"), ("coinex", "B", "coinex")]
    raw = spark.createDataFrame(
        [('{"symbol":"A","exchange":"binance","priority":0}',), ('{"symbol":"A","exchange":"coinex","priority":0}',), ("x",)],
        "value string",
    )
    routed = catalogue.route_requests(catalogue.parse_requests(raw))
    assert [r.route for r in routed.collect()] == ["load", "unsupported", "invalid"]
    assert [r.value for r in catalogue.dead_letters(routed).collect()] == ["x"]


def test_read_table_by_name_and_path(spark, folder):
    spark.range(3).write.parquet(f"{folder}/t")
    spark.range(4).createOrReplaceTempView("four")
    assert read_table(spark, f"{folder}/t").count() == 3
    assert read_table(spark, "four").count() == 4
    spark.range(2).write.json(f"{folder}/j")
    assert read_table(spark, f"{folder}/j", format="json").count() == 2


def test_csv_plan_prunes_by_name_only(spark, folder):
    put(folder, "BTC-1h-2025-01.csv", GOOD)
    assert "Python" not in plan(csv_bars.read_bars(spark, folder))
