"""One query per operator, each over whole tables of `sf_dir`."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone
from functools import cache, wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlemill.functions import scalar, temporal, text
from candlemill.functions.sql import register_functions
from candlemill.operators import bars as bar_operators
from candlemill.operators import dedup, indicators, marks, moving, ranking
from candlemill.operators.ema import add_ema
from candlemill.plans import backfill, compact, load
from candlemill.registry import files
from candlemill.registry.files import event_bars, event_requests, order_bars, order_requests, table
from candlemill.schema import COLLECTIONS, CORRUPT, TIMEFRAMES, stored_schema, table_name_column
from candlemill.session import scratch_dir, use_utc
from candlemill.sources import archives, catalogue, csv_bars
from candlemill.sources.collection import Collection, CollectionStore
from candlemill.sources.series_files import SeriesFiles
from candlemill.sources.store import BarStore, CatalogStore, PathStore, read_table
from candlemill.streaming import bars as bar_stream
from candlemill.streaming import ingest
from candlemill.streaming import requests as request_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BAR = ["cuote_open", "cuote_high", "cuote_low", "cuote_close", "volume", "qtde_trades"]
SPLIT = "2024-01-15"
BACKFILL = {"start": "1995-01-01", "end": "2001-08-20", "today": "2001-08-20"}


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _out(df: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns, floats to 6 places, timestamps without zone."""
    picked = []
    for c in columns:
        kind = df.schema[c].dataType.typeName()
        value = F.col(c)
        if kind == "double":
            value = F.round(c, 6)
        elif kind == "timestamp":
            value = F.col(c).cast("timestamp_ntz")
        picked.append(value.alias(c))
    return df.select(*picked)


def _bars_out(df: DataFrame, *more: str) -> DataFrame:
    return _out(df, "index", "cuote_timestamp", *more, *BAR)


@cache
def _stored(spark: SparkSession, sf_dir: str) -> PathStore:
    """A store with hourly bars of events and daily bars of orders, shared by the reading queries."""
    store = PathStore(spark, scratch_dir(spark, "stored"))
    for timeframe, bars in (("1h", event_bars(spark, sf_dir)), ("1d", order_bars(spark, sf_dir))):
        load.load_incremental(store, bars, timeframe)
    return store


def _catalog(spark: SparkSession, label: str) -> CatalogStore:
    location = scratch_dir(spark, label)
    return CatalogStore(spark, f"bars_{location.rsplit('-', 1)[1]}", location)


# --- bars and windows -------------------------------------------------------


@query
def bars_from_events(spark, sf_dir):
    return _bars_out(event_bars(spark, sf_dir, list(TIMEFRAMES)), "timeframe")


@query
def roll_up(spark, sf_dir):
    """Daily and weekly bars from stored hourly bars."""
    stored = _stored(spark, sf_dir).read("1h")
    return _bars_out(bar_operators.roll_up(stored, ["1d", "1w"]), "timeframe")


@query
def moving_average(spark, sf_dir):
    df = moving.add_moving_average(event_bars(spark, sf_dir), "cuote_close", 14, "value")
    return _out(df, "index", "cuote_timestamp", "value")


@query
def price_change(spark, sf_dir):
    df = moving.add_price_change(event_bars(spark, sf_dir), "cuote_close", 1, "value")
    return _out(df, "index", "cuote_timestamp", "value")


@query
def moving_stddev(spark, sf_dir):
    df = moving.add_moving_stddev(event_bars(spark, sf_dir), "cuote_close", 20, "value")
    return _out(df, "index", "cuote_timestamp", "value")


@query
def moving_highest(spark, sf_dir):
    df = moving.add_moving_highest(event_bars(spark, sf_dir), "cuote_high", 14, "value")
    return _out(df, "index", "cuote_timestamp", "value")


@query
def moving_lowest(spark, sf_dir):
    df = moving.add_moving_lowest(event_bars(spark, sf_dir), "cuote_low", 14, "value")
    return _out(df, "index", "cuote_timestamp", "value")


@query
def chunked_window(spark, sf_dir):
    """15-minute bars in chunks of one day, so that most frames near a cut cross it."""
    bars = event_bars(spark, sf_dir, "15m")
    df = moving.add_moving_average(bars, "cuote_close", 14, "value", chunk_days=1)
    return _out(df, "index", "cuote_timestamp", "value")


@query
def rsi(spark, sf_dir):
    df = indicators.add_rsi(event_bars(spark, sf_dir), 14)
    return _out(df, "index", "cuote_timestamp", "in_RSI")


@query
def rsi_textbook(spark, sf_dir):
    df = indicators.add_rsi(event_bars(spark, sf_dir, "15m"), 3, zero_loss="textbook")
    return _out(df, "index", "cuote_timestamp", "in_RSI")


@query
def bollinger(spark, sf_dir):
    df = indicators.add_bollinger(event_bars(spark, sf_dir), 20)
    return _out(df, "index", "cuote_timestamp", "in_BBandMiddle", "in_BBandLower", "in_BBandUpper")


@query
def stochastic(spark, sf_dir):
    df = indicators.add_stochastic(event_bars(spark, sf_dir), 14, 3)
    return _out(df, "index", "cuote_timestamp", "in_StochLineK", "in_StochLineD")


@query
def all_indicators(spark, sf_dir):
    """The three indicators together, per symbol and timeframe."""
    bars = event_bars(spark, sf_dir, list(TIMEFRAMES))
    df = indicators.add_indicators(bars, partition_cols=("index", "timeframe"))
    names = [c for c in df.columns if c.startswith("in_")]
    return _out(df, "index", "timeframe", "cuote_timestamp", *names)


@query
def ema(spark, sf_dir):
    df = add_ema(event_bars(spark, sf_dir), 14)
    return _out(df, "index", "cuote_timestamp", "in_EMA")


@query
def indicators_across_chunks(spark, sf_dir):
    """All indicators over seven years of daily bars, in chunks of 14 days: most frames cross a cut."""
    bars = order_bars(spark, sf_dir)
    df = add_ema(indicators.add_indicators(bars, chunk_days=14), 14, chunk_days=14)
    # Prices go up to half a million, so six places would be below what a double sum keeps.
    rounded = {c: F.round(c, 2) for c in df.columns if c.startswith("in_")}
    return _out(df.withColumns(rounded), "index", "cuote_timestamp", *rounded)


@query
def sorted_output(spark, sf_dir):
    df = indicators.add_rsi(event_bars(spark, sf_dir, "15m"), 14)
    return _out(df, "cuote_timestamp", "index", "in_RSI").orderBy("cuote_timestamp", "index")


# --- row formulas -----------------------------------------------------------

_LINE = ["l_orderkey", "l_linenumber", "l_partkey"]


@query
def safe_division(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("value", scalar.safe_division("l_quantity", F.col("l_discount") - 0.03))
    return _out(df, *_LINE, "value")


@query
def gain_loss(spark, sf_dir):
    change = F.col("value") - 100
    df = table(spark, sf_dir, "events").withColumns({"gain": scalar.gain(change), "loss": scalar.loss(change)})
    return _out(df, "event_id", "gain", "loss")


@query
def rsi_from_ratio(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("value", scalar.rsi_from_ratio(F.col("l_tax") * 25 - 1))
    return _out(df, *_LINE, "value")


@query
def stochastic_k(spark, sf_dir):
    df = event_bars(spark, sf_dir, "15m").withColumn(
        "value", scalar.stochastic_k("cuote_close", "cuote_high", "cuote_low")
    )
    return _out(df, "index", "cuote_timestamp", "value")


@query
def bollinger_bounds(spark, sf_dir):
    deviation = F.when(F.col("l_discount") > 0, F.col("l_quantity"))
    df = table(spark, sf_dir, "lineitem").withColumns(
        {
            "lower": scalar.bollinger_lower("l_extendedprice", deviation),
            "upper": scalar.bollinger_upper("l_extendedprice", deviation),
        }
    )
    return _out(df, *_LINE, "lower", "upper")


@query
def sql_functions(spark, sf_dir):
    """The formulas as SQL functions."""
    register_functions(spark)
    event_bars(spark, sf_dir).createOrReplaceTempView("candlemill_hourly")
    df = spark.sql(
        "SELECT `index`, cuote_timestamp, bar_division(volume, qtde_trades - 2) AS divided,"
        " bar_gain(cuote_close - cuote_open) AS gain, bar_loss(cuote_close - cuote_open) AS loss,"
        " bar_rsi(cuote_close / cuote_high) AS rsi, bar_stochastic_k(cuote_close, cuote_high, cuote_low) AS k,"
        " bar_band_lower(cuote_close, cuote_high) AS lower, bar_band_upper(cuote_close, cuote_high) AS upper"
        " FROM candlemill_hourly"
    )
    return _out(df, *df.columns)


@query
def epoch_normalize(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("t", F.col("ts").cast("timestamp"))
    number = F.when(F.col("t") >= SPLIT, F.unix_micros("t")).otherwise(F.unix_millis("t"))
    df = events.withColumn("cuote_timestamp", temporal.epoch_to_timestamp(number))
    return _out(df, "event_id", "cuote_timestamp")


@query
def calendar_columns(spark, sf_dir):
    df = table(spark, sf_dir, "orders").withColumns(temporal.calendar_columns("o_orderdate"))
    return _out(df, "o_orderkey", "cuote_date", "cuote_year", "cuote_month")


# --- files ------------------------------------------------------------------


@query
def csv_bar_scan(spark, sf_dir):
    """One CSV per series."""
    folder = scratch_dir(spark, "csv")
    files.write_archives(event_bars(spark, sf_dir), folder, None)
    return _bars_out(csv_bars.read_bars(spark, folder), "timeframe", "cuote_date", "cuote_year", "cuote_month")


@query
def archive_scan(spark, sf_dir):
    """All monthly archives of all series of two timeframes, one after the other."""
    folder = scratch_dir(spark, "archives")
    files.write_archives(order_bars(spark, sf_dir, ["1d", "1w"]), folder, "yyyy-MM")
    return _bars_out(csv_bars.read_bars(spark, folder), "timeframe", "period", "cuote_date", "cuote_year", "cuote_month")


@query
def archive_scan_since(spark, sf_dir):
    """Monthly archives of two timeframes, read from January 1997 on."""
    folder = scratch_dir(spark, "archives")
    files.write_archives(order_bars(spark, sf_dir, ["1d", "1w"]), folder, "yyyy-MM")
    df = csv_bars.read_bars(spark, folder, since_period="1997-01")
    return _bars_out(df, "timeframe", "period")


@query
def zip_archive_scan(spark, sf_dir):
    """Zipped daily archives."""
    folder = scratch_dir(spark, "zips")
    files.write_archives(event_bars(spark, sf_dir, "30m"), folder, "yyyy-MM-dd", "zip")
    df = csv_bars.as_bars(archives.read_zip_records(spark, folder))
    return _bars_out(df, "timeframe", "period")


@query
def bad_rows(spark, sf_dir):
    """Records of a CSV folder in which the lines of one event type are malformed."""
    folder = scratch_dir(spark, "bad")
    events = table(spark, sf_dir, "events")
    good = F.concat_ws(
        ",", F.unix_millis(F.col("ts").cast("timestamp")), *["value"] * 5, F.lit("0"), F.lit("0"), F.lit("1"), *[F.lit("0")] * 3
    )
    short = F.concat_ws(",", "event_type", "event_id")
    line = F.when(F.col("event_type") == "error", short).otherwise(good)
    events.select(line.alias("value")).write.text(f"{folder}/lines")
    bad = csv_bars.bad_rows(csv_bars.read_records(spark, f"{folder}/lines"), "all", "1h")
    return bad.select(F.col(CORRUPT).alias("line"))


@query
def dedup_bars(spark, sf_dir):
    """Every bar comes from a monthly archive, with another volume, and from a daily one."""
    bars = event_bars(spark, sf_dir, list(TIMEFRAMES))
    daily = bars.withColumn("period", F.date_format("cuote_timestamp", "yyyy-MM-dd"))
    monthly = bars.withColumns({"period": F.date_format("cuote_timestamp", "yyyy-MM"), "volume": F.lit(-1.0)})
    return _bars_out(dedup.dedup_bars(monthly.unionByName(daily)), "timeframe", "period")


@query
def last_timestamp(spark, sf_dir):
    folder = scratch_dir(spark, "last")
    files.write_archives(order_bars(spark, sf_dir, ["1d", "1w"]), folder, "yyyy-MM")
    df = csv_bars.last_timestamps(csv_bars.read_records(spark, folder))
    return _out(df, "index", "timeframe", "last_timestamp")


# --- stored bars ------------------------------------------------------------


@query
def partitioned_append(spark, sf_dir):
    """Two appends to a folder and two to a catalogue table."""
    bars = event_bars(spark, sf_dir, "4h").withColumns(temporal.calendar_columns())
    outs = []
    for store in (PathStore(spark, scratch_dir(spark, "append")), _catalog(spark, "append")):
        early = F.col("cuote_timestamp") < SPLIT
        store.append("4h", bars.where(early))
        store.append("4h", bars.where(~early))
        outs.append(_bars_out(store.read("4h").withColumn("store", F.lit(type(store).__name__)), "store", "cuote_date"))
    return outs[0].unionByName(outs[1])


@query
def table_scan(spark, sf_dir):
    store = _stored(spark, sf_dir)
    return _bars_out(read_table(spark, store.location("1d"), schema=stored_schema("1d")))


@query
def read_market(spark, sf_dir):
    return _bars_out(_stored(spark, sf_dir).read_market("click", "1h"))


@query
def filter_symbol(spark, sf_dir):
    df = event_bars(spark, sf_dir, "15m").where(F.col("index") == F.lit("view"))
    return _bars_out(df)


@query
def timeframe_route(spark, sf_dir):
    df = event_bars(spark, sf_dir, list(TIMEFRAMES)).withColumn("table", table_name_column("timeframe"))
    return _out(df, "index", "timeframe", "cuote_timestamp", "table")


@query
def last_partition_read(spark, sf_dir):
    """Newest day of every symbol in the hourly table, newest month in the daily one."""
    store = _stored(spark, sf_dir)
    hourly = _bars_out(store.read_last_partitions("1h"))
    return hourly.unionByName(_bars_out(store.read_last_partitions("1d")))


@query
def high_water_mark(spark, sf_dir):
    store = _stored(spark, sf_dir)
    return _out(store.marks("1h").unionByName(store.marks("1d")), "index", "mark")


@query
def latest_row(spark, sf_dir):
    df = dedup.latest_row(event_bars(spark, sf_dir, list(TIMEFRAMES)), ["index", "timeframe"])
    return _bars_out(df, "timeframe")


@query
def latest_partition_date(spark, sf_dir):
    return _stored(spark, sf_dir).newest_partitions("1h").select("index", "cuote_date")


@query
def latest_partition_ym(spark, sf_dir):
    return _stored(spark, sf_dir).newest_partitions("1d").select("index", "cuote_year", "cuote_month")


@query
def parse_partition_string(spark, sf_dir):
    """Partition names of both layouts, one per order."""
    orders = table(spark, sf_dir, "orders").withColumns(temporal.calendar_columns("o_orderdate"))
    by_day = F.concat(F.lit("index="), "o_orderpriority", F.lit("/cuote_date="), F.col("cuote_date").cast("string"))
    by_month = F.concat(
        F.lit("index="), "o_orderpriority", F.lit("/cuote_year="), "cuote_year", F.lit("/cuote_month="), "cuote_month"
    )
    df = orders.withColumn("partition", F.when(F.col("o_orderstatus") == "O", by_month).otherwise(by_day))
    return df.select(
        "o_orderkey",
        text.partition_symbol("partition").alias("index"),
        text.partition_date("partition").alias("cuote_date"),
        text.partition_year_month("partition").alias("year_month"),
    )


@query
def incremental_filter(spark, sf_dir):
    """Marks in mid-month for all event types but one, which has none."""
    bars = event_bars(spark, sf_dir, "15m")
    stored = bars.where((F.col("cuote_timestamp") < SPLIT) & (F.col("index") != "signup"))
    return _bars_out(marks.newer_than_marks(bars, marks.high_water_mark(stored)))


@query
def table_inventory(spark, sf_dir):
    return _stored(spark, sf_dir).inventory()


# --- load pipelines ---------------------------------------------------------


def _load_twice(store: BarStore, bars: DataFrame, timeframe: str) -> None:
    load.load_incremental(store, bars.where(F.col("cuote_timestamp") < SPLIT), timeframe)
    load.load_incremental(store, bars, timeframe)
    load.load_incremental(store, bars, timeframe)


@query
def incremental_load(spark, sf_dir):
    """Half the bars, all of them, all of them again: each is stored once."""
    store = PathStore(spark, scratch_dir(spark, "incremental"))
    _load_twice(store, event_bars(spark, sf_dir), "1h")
    return _bars_out(store.read("1h"))


@query
def incremental_load_catalog(spark, sf_dir):
    store = _catalog(spark, "incremental")
    _load_twice(store, event_bars(spark, sf_dir, "4h"), "4h")
    return _bars_out(store.read("4h"))


@query
def incremental_load_collection(spark, sf_dir):
    """As `incremental_load`, in five collections; one event type comes late, so it is behind the newest bar of all."""
    store = CollectionStore(spark, scratch_dir(spark, "collection"))
    late, outs = F.col("index") == "signup", []
    for timeframe in COLLECTIONS:
        bars = event_bars(spark, sf_dir, timeframe)
        load.load_collection(store, bars.where((F.col("cuote_timestamp") < SPLIT) & ~late), timeframe)
        load.load_collection(store, bars.where(~late), timeframe)
        load.load_collection(store, bars, timeframe)
        load.load_collection(store, bars, timeframe)
        outs.append(_bars_out(store.read(timeframe).withColumn("timeframe", F.lit(timeframe)), "timeframe"))
    for other in outs[1:]:
        outs[0] = outs[0].unionByName(other)
    return outs[0]


@query
def collection_replace(spark, sf_dir):
    """Documents of customers, replaced by each customer's newest order; twice, with the same result."""
    documents = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_id"),
        F.col("c_acctbal").alias("amount"),
        F.lit(None).cast("bigint").alias("o_orderkey"),
        F.lit(None).cast("timestamp_ntz").alias("updated"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("_id"), F.col("o_totalprice").alias("amount"), "o_orderkey", F.col("o_orderdate").alias("updated")
    )
    collection = Collection(spark, scratch_dir(spark, "documents"), documents.schema, ["_id"])
    collection.append(documents)
    for _ in range(2):
        collection.replace(orders, "_id", ["updated", "o_orderkey"])
    return _out(collection.read(), "_id", "amount", "o_orderkey", "updated")


@query
def full_reload(spark, sf_dir):
    """Wrong bars, shifted by a year so that other partitions hold them, are replaced for all symbols but one."""
    bars = order_bars(spark, sf_dir)
    keep = F.col("index") == "5-LOW"
    out = None
    for store in (PathStore(spark, scratch_dir(spark, "reload")), _catalog(spark, "reload")):
        wrong = bars.withColumn("cuote_timestamp", F.col("cuote_timestamp") - F.expr("interval 365 days"))
        load.load_incremental(store, wrong, "1d")
        load.full_reload(store, bars.where(~keep), "1d")
        rows = _bars_out(store.read("1d").withColumn("store", F.lit(type(store).__name__)), "store")
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def load_all_timeframes(spark, sf_dir):
    """Six tables from one folder of monthly archives; each job opens the files of its timeframe."""
    folder = scratch_dir(spark, "all")
    files.write_archives(event_bars(spark, sf_dir, list(TIMEFRAMES)), folder, "yyyy-MM")
    store = PathStore(spark, scratch_dir(spark, "tables"))
    load.load_all_timeframes(store, {t: csv_bars.read_bars(spark, f"{folder}/*-{t}-*.csv") for t in TIMEFRAMES})
    outs = [_bars_out(store.read(t).withColumn("timeframe", F.lit(t)), "timeframe") for t in TIMEFRAMES]
    for other in outs[1:]:
        outs[0] = outs[0].unionByName(other)
    return outs[0]


@query
def upsert_replace(spark, sf_dir):
    """A row per customer, replaced by the customer's newest order."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_id"),
        F.col("c_acctbal").alias("amount"),
        F.lit(None).cast("bigint").alias("o_orderkey"),
        F.lit(None).cast("timestamp_ntz").alias("updated"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("_id"), F.col("o_totalprice").alias("amount"), "o_orderkey", F.col("o_orderdate").alias("updated")
    )
    df = dedup.upsert_replace(customers, orders, "_id", ["updated", "o_orderkey"])
    return _out(df, "_id", "amount", "o_orderkey", "updated")


@query
def replace_by_key(spark, sf_dir):
    """Stored daily bars of one priority class get a new volume."""
    bars = order_bars(spark, sf_dir)
    store = PathStore(spark, scratch_dir(spark, "replace"))
    load.load_incremental(store, bars, "1d")
    updates = bars.where(F.col("index") == "2-HIGH").withColumn("volume", F.lit(0.0))
    load.replace_by_key(store, updates, "1d")
    return _bars_out(store.read("1d"))


@query
def drop_symbol(spark, sf_dir):
    out = None
    for store in (PathStore(spark, scratch_dir(spark, "drop")), _catalog(spark, "drop")):
        load.load_incremental(store, event_bars(spark, sf_dir, "4h"), "4h")
        load.drop_symbols(store, "4h", ["error"])
        rows = _bars_out(store.read("4h").withColumn("store", F.lit(type(store).__name__)), "store")
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def compact_partitions(spark, sf_dir):
    """Bars appended event type by hour of day, then compacted; `files` counts per partition."""
    store = PathStore(spark, scratch_dir(spark, "compact"))
    bars = event_bars(spark, sf_dir).withColumns(temporal.calendar_columns())
    for night in (True, False):
        store.append("1h", bars.where((F.hour("cuote_timestamp") < 12) == night))
    compact.compact_partitions(store, "1h")
    counts = store.files("1h").groupBy("index", "cuote_date").agg(F.count(F.lit(1)).alias("files"))
    return _bars_out(store.read("1h").join(counts, ["index", "cuote_date"]), "files")


@query
def compact_catalogue(spark, sf_dir):
    """The same in a catalogue table, whose partitions are pointed to the new files."""
    store = _catalog(spark, "compact")
    bars = event_bars(spark, sf_dir).withColumns(temporal.calendar_columns())
    for night in (True, False):
        store.append("1h", bars.where((F.hour("cuote_timestamp") < 12) == night))
    compact.compact_partitions(store, "1h")
    return _bars_out(store.read("1h").join(store.file_counts("1h"), ["index", "cuote_date"]), "files")


@query
def backfill_plan(spark, sf_dir):
    """Per customer and timeframe, from the newest order; customers of one segment start anew."""
    orders = table(spark, sf_dir, "orders")
    newest = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("newest"))
    symbol = lambda key: F.concat(F.lit("C"), F.col(key))
    series = (
        table(spark, sf_dir, "customer")
        .join(newest, "c_custkey", "left")
        .select(
            symbol("c_custkey").alias("index"),
            F.explode(F.array(*[F.lit(t) for t in TIMEFRAMES])).alias("timeframe"),
            F.when(F.col("c_mktsegment") != "MACHINERY", F.col("newest")).alias("last_timestamp"),
        )
    )
    manifest = orders.select(
        F.concat(symbol("o_custkey"), F.lit("-1d-"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".zip")).alias("file_name")
    )
    return backfill.backfill_plan(series, **BACKFILL, manifest=manifest)


# --- assets and requests ----------------------------------------------------


@query
def asset_catalog(spark, sf_dir):
    folder = scratch_dir(spark, "assets")
    table(spark, sf_dir, "customer").select(
        F.concat(F.lower("c_mktsegment"), F.lit("_"), "c_name").alias("id"),
        F.concat(F.lit("C"), F.col("c_custkey")).alias("symbol"),
    ).write.json(f"{folder}/list")
    return catalogue.read_assets(spark, f"{folder}/list").select("id", "symbol", "exchange")


@query
def open_assets(spark, sf_dir):
    status = F.when(F.col("c_acctbal") >= 0, F.lit("open")).otherwise(F.lit("closed"))
    assets = table(spark, sf_dir, "customer").select(F.col("c_name").alias("_id"), status.alias("status"))
    return catalogue.open_assets(assets)


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.route_requests(catalogue.parse_requests(order_requests(spark, sf_dir)))


@query
def request_parse(spark, sf_dir):
    parsed = catalogue.parse_requests(order_requests(spark, sf_dir)).where(F.col("valid"))
    return parsed.select("o_orderkey", "symbol", "exchange", "priority")


@query
def request_route(spark, sf_dir):
    return _routed(spark, sf_dir).select("o_orderkey", "route")


@query
def request_priority(spark, sf_dir):
    loads = _routed(spark, sf_dir).where(F.col("route") == "load")
    df = ranking.with_service_position(loads, ["arrival", "o_orderkey"])
    return df.select("o_orderkey", "priority", F.col("position").cast("bigint").alias("position"))


@query
def dead_letter(spark, sf_dir):
    return catalogue.dead_letters(_routed(spark, sf_dir)).select("o_orderkey", "value")


# --- streams ----------------------------------------------------------------


def _tally(rows: DataFrame, kind: str, symbol: str) -> DataFrame:
    named = rows.select(F.lit(kind).alias("kind"), F.coalesce(symbol, F.lit("")).alias("symbol"))
    return named.groupBy("kind", "symbol").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_requests(spark, sf_dir):
    """A stream of one request per event for its type, whose bars of all timeframes are loaded.

    Three types are served at a time; `round` gives the round of each.
    """
    base = scratch_dir(spark, "requests")
    event_requests(spark, sf_dir).select("value").write.text(f"{base}/in")
    files.write_archives(event_bars(spark, sf_dir, list(TIMEFRAMES)), f"{base}/files", None)
    store, source = PathStore(spark, f"{base}/tables"), SeriesFiles(spark, f"{base}/files")
    service = request_stream.RequestService(store, lambda symbols, t, _: source.bars(symbols, t), f"{base}/log", per_round=3)
    request_stream.stream_requests(service, f"{base}/in", f"{base}/checkpoint").awaitTermination()

    out = service.attempts().select(F.lit("round").alias("kind"), "symbol", F.col("round").cast("bigint").alias("n"))
    for timeframe in TIMEFRAMES:
        out = out.unionByName(_tally(store.read(timeframe), f"{timeframe} bars", "index"))
    for kind in ("accepted", "unsupported", "rejected"):
        out = out.unionByName(_tally(spark.read.schema("symbol string").parquet(f"{base}/log/{kind}"), kind, "symbol"))
    return out


@query
def request_retry(spark, sf_dir):
    """Requests per priority class, in one round; the bars of one class cannot be read until its third try.

    The other classes are loaded at once. `n` is the try, its minute, or the number of bars.
    """
    base, begin = scratch_dir(spark, "retry"), datetime(2025, 1, 1)
    bars = order_bars(spark, sf_dir, "1w")

    def source(symbols: Sequence[str], timeframe: str, now: datetime) -> DataFrame:
        broken = (F.col("index") == "2-HIGH") & F.lit(now < begin + timedelta(minutes=15))
        unread = F.when(broken, F.raise_error(F.lit("no such file")).cast("double")).otherwise(F.col("volume"))
        return bars.where(F.col("index").isin(*symbols)).withColumn("volume", unread)

    store = PathStore(spark, f"{base}/tables")
    service = request_stream.RequestService(store, source, f"{base}/log", ["1w"])
    requests = order_requests(spark, sf_dir, F.col("o_orderpriority")).select("value", "arrival")
    service.serve(requests, "0", begin)
    for minutes in (4, 5, 14, 15, 60):
        service.retry(f"retry-{minutes}", begin + timedelta(minutes=minutes))
    tries = service.attempts()
    minute = (F.unix_seconds("tried_at") - int(begin.replace(tzinfo=timezone.utc).timestamp())) / 60
    out = tries.select(F.concat(F.lit("try "), F.col("status")).alias("kind"), "symbol", F.col("attempt").cast("bigint").alias("n"))
    out = out.unionByName(tries.select(F.lit("minute").alias("kind"), "symbol", minute.cast("bigint").alias("n")))
    return out.unionByName(_tally(store.read("1w"), "bars", "index"))


@query
def stream_incremental_load(spark, sf_dir):
    """Monthly files of all timeframes as a stream."""
    base = scratch_dir(spark, "stream")
    files.write_archives(event_bars(spark, sf_dir, list(TIMEFRAMES)), f"{base}/in", "yyyy-MM")
    store = PathStore(spark, f"{base}/tables")
    records = ingest.stream_records(store, f"{base}/in")
    ingest.stream_incremental_load(store, records, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    outs = [_bars_out(store.read(t).withColumn("timeframe", F.lit(t)), "timeframe") for t in TIMEFRAMES]
    for other in outs[1:]:
        outs[0] = outs[0].unionByName(other)
    return outs[0]


@query
def stream_accounting(spark, sf_dir):
    """Bars of all timeframes, then the same again beside bars of ten weeks before and files without a symbol."""
    base = scratch_dir(spark, "accounted")
    bars = event_bars(spark, sf_dir, list(TIMEFRAMES))
    store = PathStore(spark, f"{base}/tables")

    def ingest_all() -> None:
        records = ingest.stream_records(store, f"{base}/in")
        ingest.stream_incremental_load(
            store, records, f"{base}/log", f"{base}/checkpoint", dedup_within="40 days"
        ).awaitTermination()

    files.write_archives(bars, f"{base}/in", "yyyy-MM")
    ingest_all()
    early = bars.withColumn("cuote_timestamp", F.col("cuote_timestamp") - F.expr("interval 70 days"))
    files.write_archives(early, f"{base}/in", "yyyy-MM")
    files.write_archives(bars, f"{base}/in", None)
    table(spark, sf_dir, "events").select("event_type").write.mode("append").text(f"{base}/in")
    ingest_all()
    counts = spark.read.parquet(f"{base}/log/counts").groupBy("timeframe").agg(
        *[F.sum(c).alias(c) for c in ("loaded", "dropped", "duplicates")]
    )
    batches = spark.read.parquet(f"{base}/log/batches").agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad"))
    return counts.crossJoin(batches)


@query
def stream_bars(spark, sf_dir):
    """Hourly bars kept up to date by a stream of events."""
    base = scratch_dir(spark, "bars")
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    bars = bar_stream.stream_bars_from_events(events, "event_type", "ts", "value", "1h")
    bar_stream.write_bar_updates(bars, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    return _bars_out(bar_stream.read_bar_updates(spark, f"{base}/log"))


@query
def stream_bars_late(spark, sf_dir):
    """Hourly bars from three files of events, the newest first and one per batch."""
    base = scratch_dir(spark, "late-bars")
    events = table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    for part in (day > 20, (day > 10) & (day <= 20), day <= 10):
        events.where(part).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    bars = bar_stream.stream_bars_from_events(stream, "event_type", "ts", "value", "1h")
    bar_stream.write_bar_updates(bars, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    return _bars_out(bar_stream.read_bar_updates(spark, f"{base}/log"))


@query
def load_accounting(spark, sf_dir):
    """The same records loaded three times: some of a file without an archive name, some malformed, some without symbol."""
    base = scratch_dir(spark, "accounting")
    events = table(spark, sf_dir, "events")
    good = F.concat_ws(
        ",", F.unix_millis(F.col("ts").cast("timestamp")), *["value"] * 5, F.lit("0"), F.lit("0"), F.lit("1"), *[F.lit("0")] * 3
    )
    line = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(good).alias("line")
    named = F.col("event_type").isin("click", "error")
    name = F.when(named, "unnamed.csv").otherwise(F.concat("event_type", F.lit("-1h-2024-01.csv"))).alias("file_name")
    records = csv_bars.records_of_lines(events.select(line, name))
    bad = csv_bars.bad_rows(records).count()
    bars = csv_bars.as_bars(records)
    bars = bars.unionByName(bars.where("index = 'view'").withColumn("index", F.lit(None).cast("string")))
    store, rows = PathStore(spark, f"{base}/tables"), []
    for run in (1, 2, 3):
        counts = load.load_incremental(store, bars, "1h")
        rows.append((run, counts["loaded"], counts["dropped"], bad, store.read("1h").count()))
    return spark.createDataFrame(rows, "run int, loaded bigint, dropped bigint, bad bigint, stored bigint")


def names() -> Sequence[str]:
    return sorted(QUERIES)
