"""Bars of the test tables, and the same bars as files in the archive layout."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlemill.functions.text import request_payload
from candlemill.operators.bars import bars_from_events
from candlemill.schema import CSV_FIELDS

# From this day on the open times of the files are microseconds.
MICROS_FROM = "2024-01-15"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_bars(spark: SparkSession, sf_dir: str, timeframes: str | list[str] = "1h") -> DataFrame:
    """Bars per event type."""
    return bars_from_events(table(spark, sf_dir, "events"), "event_type", "ts", "value", timeframes)


def order_bars(spark: SparkSession, sf_dir: str, timeframes: str | list[str] = "1d") -> DataFrame:
    """Bars of several years per order priority."""
    orders = table(spark, sf_dir, "orders")
    return bars_from_events(orders, "o_orderpriority", "o_orderdate", "o_totalprice", timeframes, "o_orderkey")


def _csv_line() -> Column:
    micros = F.unix_micros("cuote_timestamp")
    opened = F.when(F.col("cuote_timestamp") >= MICROS_FROM, micros).otherwise((micros / 1000).cast("long"))
    fields = {f.name: F.col(f.name) for f in CSV_FIELDS.fields if f.name not in ("cuote_opentime", "cuote_closetime")}
    fields |= {"cuote_opentime": opened, "cuote_closetime": opened}
    return F.to_csv(F.struct(*[fields[f.name].alias(f.name) for f in CSV_FIELDS.fields]))


def _zipped(key: tuple, lines: pd.DataFrame) -> pd.DataFrame:
    """The archive of one file, less its last byte: a comment of one line break, which the text writer adds."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        with archive.open(f"{key[0].removesuffix('.zip')}.csv", "w") as out:
            for line in lines.sort_values("cuote_timestamp")["line"]:
                out.write(f"{line}\n".encode())
        archive.comment = b"\n"
    return pd.DataFrame({"name": [key[0]], "content": [buffer.getvalue()[:-1]]})


def write_archives(bars: DataFrame, folder: str, period: str | None, kind: str = "csv") -> None:
    """One file per series and period (a date pattern; None: one file per series), in any file system Spark writes to.

    Spark's text writer streams the lines of a file, sorted by time; none is held as a whole. A zip archive
    is put together in memory, so it should have a period. Files are written aside and named when all are whole.
    """
    spark = bars.sparkSession
    stem = ["index", "timeframe"] if period is None else ["index", "timeframe", F.date_format("cuote_timestamp", period)]
    rows = bars.select(
        F.concat(F.concat_ws("-", *stem), F.lit(f".{kind}")).alias("name"), "cuote_timestamp", _csv_line().alias("line")
    )
    if kind == "zip":
        archives = rows.groupBy("name").applyInPandas(_zipped, "name string, content binary")
        files = archives.select("name", F.col("content").cast("string").alias("value"))
    else:
        files = rows.repartition("name").sortWithinPartitions("name", "cuote_timestamp").select("name", F.col("line").alias("value"))
    aside = f"{folder}/.aside-{uuid.uuid4().hex}"  # of the same file system, and hidden from readers
    files.write.partitionBy("name").text(aside)
    path = spark._jvm.org.apache.hadoop.fs.Path
    target = path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    unescaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for part in fs.globStatus(path(f"{aside}/name=*/part-*")) or []:
        source = part.getPath()
        named = path(target, unescaped(source.getParent().getName().removeprefix("name=")))
        fs.delete(named, False)
        if not fs.rename(source, named):
            raise OSError(f"cannot name {named}")
    fs.delete(path(aside), True)


def order_requests(spark: SparkSession, sf_dir: str, symbol: Column | None = None) -> DataFrame:
    """A load request per order; those of one priority class are cut off half-way."""
    orders = table(spark, sf_dir, "orders")
    exchange = F.when(F.col("o_orderstatus") == "P", F.lit("coinex")).otherwise(F.lit("binance"))
    symbol = F.concat(F.lit("C"), F.col("o_custkey")) if symbol is None else symbol
    payload = request_payload(symbol, exchange, F.substring("o_orderpriority", 1, 1))
    cut = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    return orders.select(
        "o_orderkey",
        F.col("o_orderdate").alias("arrival"),
        F.when(cut, F.substring(payload, 1, 12)).otherwise(payload).alias("value"),
    )


def event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load request per event for its type: of every ten users one asks another exchange, one is cut off half-way."""
    priority = F.when(F.col("event_type") == "error", F.lit(3)).otherwise(F.length("event_type"))
    exchange = F.when(F.col("user_id") % 10 == 0, F.lit("coinex")).otherwise(F.lit("binance"))
    payload = request_payload("event_type", exchange, priority)
    cut = F.when(F.col("user_id") % 10 == 1, F.substring(payload, 1, 12)).otherwise(payload)
    return table(spark, sf_dir, "events").select("event_id", cut.alias("value"))
