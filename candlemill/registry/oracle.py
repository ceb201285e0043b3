"""The same queries as SQL over the test tables, for comparison."""

from __future__ import annotations

from candlemill.registry.queries import BACKFILL, SPLIT
from candlemill.schema import COLLECTIONS, TABLES, TIMEFRAMES

_STARTS = {
    "15m": "time_bucket(INTERVAL '15 minutes', {ts})",
    "30m": "time_bucket(INTERVAL '30 minutes', {ts})",
    "1h": "date_trunc('hour', {ts})",
    "4h": "time_bucket(INTERVAL '4 hours', {ts})",
    "1d": "CAST(date_trunc('day', {ts}) AS TIMESTAMP)",
    "1w": "CAST(date_trunc('week', {ts}) AS TIMESTAMP)",
}


def _events(timeframe: str) -> str:
    return f"""SELECT event_type AS "index", '{timeframe}' AS timeframe, {_STARTS[timeframe].format(ts="ts")} AS cuote_timestamp,
        arg_min(value, ts) AS cuote_open, max(value) AS cuote_high, min(value) AS cuote_low,
        arg_max(value, ts) AS cuote_close, sum(value) AS volume, CAST(count(*) AS INTEGER) AS qtde_trades
      FROM events GROUP BY 1, 2, 3"""


def _orders(timeframe: str) -> str:
    return f"""SELECT o_orderpriority AS "index", '{timeframe}' AS timeframe, {_STARTS[timeframe].format(ts="o_orderdate")} AS cuote_timestamp,
        arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS cuote_open, max(o_totalprice) AS cuote_high,
        min(o_totalprice) AS cuote_low, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS cuote_close,
        sum(o_totalprice) AS volume, CAST(count(*) AS INTEGER) AS qtde_trades
      FROM orders GROUP BY 1, 2, 3"""


def _all(make, timeframes=TIMEFRAMES) -> str:
    return " UNION ALL ".join(make(t) for t in timeframes)


_BAR = (
    '"index", cuote_timestamp, round(cuote_open, 6) AS cuote_open, round(cuote_high, 6) AS cuote_high,'
    " round(cuote_low, 6) AS cuote_low, round(cuote_close, 6) AS cuote_close, round(volume, 6) AS volume, qtde_trades"
)


def _frame(n: int, by: str = '"index"') -> str:
    return f"(PARTITION BY {by} ORDER BY cuote_timestamp ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


def _window(expression: str, timeframe: str = "1h") -> str:
    return f'WITH bars AS ({_events(timeframe)}) SELECT "index", cuote_timestamp, round({expression}, 6) AS value FROM bars'


def _rsi(bars: str, n: int, zero_loss: str, by: str = '"index"') -> str:
    """CTEs up to `rsi`, which holds the bars and `in_RSI`."""
    textbook = "WHEN al = 0 AND ag > 0 THEN 100.0::double" if zero_loss == "textbook" else ""
    return f"""bars AS ({bars}),
    moved AS (SELECT *, last_value(cuote_close) OVER {_frame(1, by)} - first_value(cuote_close) OVER {_frame(1, by)} AS chg FROM bars),
    averaged AS (SELECT *,
        avg(CASE WHEN chg > 0 THEN chg ELSE 0.0::double END) OVER {_frame(n, by)} AS ag,
        avg(CASE WHEN chg < 0 THEN -chg ELSE 0.0::double END) OVER {_frame(n, by)} AS al FROM moved),
    rsi AS (SELECT *, CASE {textbook} WHEN al > 0 THEN 100.0::double - 100.0::double / (1.0::double + ag / al)
        ELSE 0.0::double END AS "in_RSI" FROM averaged)"""


def _bands(source: str, by: str = '"index"', n: int = 20) -> str:
    return f"""bands AS (SELECT *, avg(cuote_close) OVER {_frame(n, by)} AS "in_BBandMiddle",
        stddev_samp(cuote_close) OVER {_frame(n, by)} AS sd FROM {source})"""


def _stochastic(source: str, by: str = '"index"', k: int = 14, d: int = 3) -> str:
    return f"""ranged AS (SELECT *, max(cuote_high) OVER {_frame(k, by)} AS hh, min(cuote_low) OVER {_frame(k, by)} AS ll FROM {source}),
    line AS (SELECT *, (CASE WHEN hh - ll > 0 THEN (cuote_close - ll) / (hh - ll) ELSE 0.0::double END) * 100 AS k FROM ranged),
    stoch AS (SELECT *, k AS "in_StochLineK", avg(k) OVER {_frame(d, by)} AS "in_StochLineD" FROM line)"""


_EMA = """numbered AS (SELECT *, row_number() OVER (PARTITION BY "index" ORDER BY cuote_timestamp) AS n FROM bars),
    ema AS (SELECT "index", cuote_timestamp, n, cuote_close AS y FROM numbered WHERE n = 1
      UNION ALL SELECT b."index", b.cuote_timestamp, b.n, (1.0::double - 2.0::double / 15) * e.y + 2.0::double / 15 * b.cuote_close
      FROM ema e JOIN numbered b ON b."index" = e."index" AND b.n = e.n + 1)"""

_BAND_COLUMNS = """round("in_BBandMiddle", 6) AS "in_BBandMiddle",
    round("in_BBandMiddle" - 2.0::double * sd, 6) AS "in_BBandLower",
    round("in_BBandMiddle" + 2.0::double * sd, 6) AS "in_BBandUpper\""""
_STOCH_COLUMNS = 'round("in_StochLineK", 6) AS "in_StochLineK", round("in_StochLineD", 6) AS "in_StochLineD"'

_SERIES = '"index", timeframe'

_CALENDAR = (
    "CAST(cuote_timestamp AS DATE) AS cuote_date, CAST(year(cuote_timestamp) AS INTEGER) AS cuote_year,"
    " CAST(month(cuote_timestamp) AS INTEGER) AS cuote_month"
)

_PAYLOAD = """SELECT *, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN left(full_text, 12) ELSE full_text END AS value,
    o_orderpriority <> '4-NOT SPECIFIED' AS valid,
    CASE WHEN o_orderstatus = 'P' THEN 'coinex' ELSE 'binance' END AS exchange,
    CAST(left(o_orderpriority, 1) AS INTEGER) AS priority
  FROM (SELECT *, '{"symbol":"C' || o_custkey || '","exchange":"' || CASE WHEN o_orderstatus = 'P' THEN 'coinex' ELSE 'binance' END
    || '","priority":' || left(o_orderpriority, 1) || '}' AS full_text FROM orders)"""
_ROUTE = "CASE WHEN NOT valid THEN 'invalid' WHEN exchange = 'binance' THEN 'load' ELSE 'unsupported' END"

_TWO_STORES = "(SELECT 'PathStore' AS store UNION ALL SELECT 'CatalogStore' AS store)"

_HOURLY = f"SELECT {_BAR} FROM ({_events('1h')})"
_DAILY = f"SELECT {_BAR} FROM ({_orders('1d')})"

_LINE = "l_orderkey, l_linenumber, l_partkey"


def _backfill() -> str:
    end, today = f"DATE '{BACKFILL['end']}'", f"DATE '{BACKFILL['today']}'"
    frames = ", ".join(f"('{t}')" for t in TIMEFRAMES)
    return f"""WITH newest AS (SELECT o_custkey, max(o_orderdate) AS newest FROM orders GROUP BY 1),
    series AS (SELECT 'C' || c_custkey AS "index", t AS timeframe,
        CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(newest AS DATE) END AS last_day
      FROM customer LEFT JOIN newest ON o_custkey = c_custkey CROSS JOIN (VALUES {frames}) AS f(t)),
    cursors AS (SELECT *, CASE WHEN last_day IS NULL THEN DATE '{BACKFILL['start']}' ELSE CAST(last_day + 1 AS DATE) END AS cur,
        CAST(date_trunc('month', {today}) AS DATE) AS this_month,
        CAST(CASE WHEN date_trunc('month', {end}) = date_trunc('month', {today})
          THEN date_trunc('month', {today}) - INTERVAL 1 MONTH ELSE date_trunc('month', {end}) END AS DATE) AS last_month FROM series),
    flags AS (SELECT *, CAST(date_trunc('month', cur) AS DATE) AS cur_month,
        last_day IS NOT NULL AND timeframe <> '1w' AND cur > date_trunc('month', cur) AS begun FROM cursors),
    months AS (SELECT "index", timeframe, 'monthly' AS kind, strftime(d, '%Y-%m') AS period FROM (
        SELECT "index", timeframe, unnest(generate_series(CAST(cur_month + CASE WHEN begun THEN INTERVAL 1 MONTH ELSE INTERVAL 0 MONTH END AS TIMESTAMP),
          CAST(last_month AS TIMESTAMP), INTERVAL 1 MONTH)) AS d FROM flags)),
    rest AS (SELECT "index", timeframe, 'daily' AS kind, strftime(d, '%Y-%m-%d') AS period FROM (
        SELECT "index", timeframe, unnest(generate_series(CAST(cur AS TIMESTAMP), CAST(least(last_day(cur), {end}) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
        FROM flags WHERE begun AND cur_month <= last_month)),
    days AS (SELECT "index", timeframe, 'daily' AS kind, strftime(d, '%Y-%m-%d') AS period FROM (
        SELECT "index", timeframe, unnest(generate_series(
          CASE WHEN last_day IS NULL THEN CAST(this_month AS TIMESTAMP) ELSE greatest(CAST(cur AS TIMESTAMP), last_month + INTERVAL 1 MONTH) END,
          CAST({end} AS TIMESTAMP), INTERVAL 1 DAY)) AS d
        FROM flags WHERE timeframe <> '1w' AND this_month <= {end})),
    plan AS (SELECT * FROM months UNION ALL SELECT * FROM rest UNION ALL SELECT * FROM days),
    named AS (SELECT *, "index" || '-' || timeframe || '-' || period || '.zip' AS file_name FROM plan)
    SELECT * FROM named WHERE file_name NOT IN (SELECT 'C' || o_custkey || '-1d-' || strftime(o_orderdate, '%Y-%m') || '.zip' FROM orders)"""


_NEWEST_ORDERS = """SELECT c_custkey AS _id, round(c_acctbal, 6) AS amount, CAST(NULL AS BIGINT) AS o_orderkey, CAST(NULL AS TIMESTAMP) AS updated
    FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT o_custkey, round(o_totalprice, 6), o_orderkey, o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""

ORACLE: dict[str, str] = {
    "bars_from_events": f"SELECT timeframe, {_BAR} FROM ({_all(_events)})",
    "roll_up": f"SELECT timeframe, {_BAR} FROM ({_all(_events, ['1d', '1w'])})",
    "stream_bars": _HOURLY,
    "stream_bars_late": _HOURLY,
    "load_accounting": """SELECT CAST(run AS INTEGER) AS run, CASE WHEN run = 1 THEN bars ELSE 0 END AS loaded,
          CASE WHEN run = 1 THEN views ELSE records + views END AS dropped, bad, bars AS stored
        FROM (SELECT count(*) FILTER (event_type IN ('click', 'error')) AS bad, count(*) FILTER (event_type = 'view') AS views,
                count(*) FILTER (event_type NOT IN ('click', 'error')) AS records,
                count(DISTINCT (event_type, date_trunc('second', ts))) FILTER (event_type NOT IN ('click', 'error')) AS bars
              FROM events), (SELECT unnest([1, 2, 3]) AS run)""",
    "moving_average": _window(f"avg(cuote_close) OVER {_frame(14)}"),
    "price_change": _window(f"last_value(cuote_close) OVER {_frame(1)} - first_value(cuote_close) OVER {_frame(1)}"),
    "moving_stddev": _window(f"stddev_samp(cuote_close) OVER {_frame(20)}"),
    "moving_highest": _window(f"max(cuote_high) OVER {_frame(14)}"),
    "moving_lowest": _window(f"min(cuote_low) OVER {_frame(14)}"),
    "chunked_window": _window(f"avg(cuote_close) OVER {_frame(14)}", "15m"),
    "rsi": f'WITH {_rsi(_events("1h"), 14, "zero")} SELECT "index", cuote_timestamp, round("in_RSI", 6) AS "in_RSI" FROM rsi',
    "rsi_textbook": f'WITH {_rsi(_events("15m"), 3, "textbook")} SELECT "index", cuote_timestamp, round("in_RSI", 6) AS "in_RSI" FROM rsi',
    "sorted_output": f'WITH {_rsi(_events("15m"), 14, "zero")} SELECT "index", cuote_timestamp, round("in_RSI", 6) AS "in_RSI" FROM rsi ORDER BY cuote_timestamp, "index"',
    "bollinger": f'WITH bars AS ({_events("1h")}), {_bands("bars")} SELECT "index", cuote_timestamp, {_BAND_COLUMNS} FROM bands',
    "stochastic": f'WITH bars AS ({_events("1h")}), {_stochastic("bars")} SELECT "index", cuote_timestamp, {_STOCH_COLUMNS} FROM stoch',
    "all_indicators": f"""WITH {_rsi(_all(_events), 14, "zero", _SERIES)}, {_bands("rsi", _SERIES)}, {_stochastic("bands", _SERIES)}
        SELECT "index", timeframe, cuote_timestamp, round("in_RSI", 6) AS "in_RSI", {_BAND_COLUMNS}, {_STOCH_COLUMNS} FROM stoch""",
    "ema": f'WITH RECURSIVE bars AS ({_events("1h")}), {_EMA} SELECT "index", cuote_timestamp, round(y, 6) AS "in_EMA" FROM ema',
    "indicators_across_chunks": f"""WITH RECURSIVE {_rsi(_orders("1d"), 14, "zero")}, {_bands("rsi")}, {_stochastic("bands")}, {_EMA}
        SELECT "index", cuote_timestamp, round("in_RSI", 2) AS "in_RSI", {f"{_BAND_COLUMNS}, {_STOCH_COLUMNS}".replace(", 6)", ", 2)")}, round(y, 2) AS "in_EMA"
        FROM stoch JOIN ema USING ("index", cuote_timestamp)""",
    "safe_division": f"""SELECT {_LINE}, round(CASE WHEN l_discount - 0.03::double > 0 THEN l_quantity / (l_discount - 0.03::double)
        ELSE 0.0::double END, 6) AS value FROM lineitem""",
    "gain_loss": """SELECT event_id, round(CASE WHEN value > 100 THEN value - 100 ELSE 0.0::double END, 6) AS gain,
        round(CASE WHEN value < 100 THEN 100 - value ELSE 0.0::double END, 6) AS loss FROM events""",
    "rsi_from_ratio": f"""SELECT {_LINE}, round(CASE WHEN r = -1 THEN 0.0::double ELSE 100.0::double - 100.0::double / (1 + r) END, 6) AS value
        FROM (SELECT *, l_tax * 25 - 1 AS r FROM lineitem)""",
    "stochastic_k": f"""SELECT "index", cuote_timestamp, round(CASE WHEN cuote_high > cuote_low
        THEN (cuote_close - cuote_low) / (cuote_high - cuote_low) ELSE 0.0::double END * 100, 6) AS value FROM ({_events("15m")})""",
    "bollinger_bounds": f"""SELECT {_LINE}, round(l_extendedprice - 2.0::double * sd, 6) AS lower, round(l_extendedprice + 2.0::double * sd, 6) AS upper
        FROM (SELECT *, CASE WHEN l_discount > 0 THEN l_quantity END AS sd FROM lineitem)""",
    "sql_functions": f"""SELECT "index", cuote_timestamp,
        round(CASE WHEN qtde_trades > 2 THEN volume / (qtde_trades - 2) ELSE 0.0::double END, 6) AS divided,
        round(greatest(cuote_close - cuote_open, 0.0::double), 6) AS gain, round(greatest(cuote_open - cuote_close, 0.0::double), 6) AS loss,
        round(100.0::double - 100.0::double / (1 + cuote_close / cuote_high), 6) AS rsi,
        round(CASE WHEN cuote_high > cuote_low THEN (cuote_close - cuote_low) / (cuote_high - cuote_low) ELSE 0.0::double END * 100, 6) AS k,
        round(cuote_close - 2 * cuote_high, 6) AS lower, round(cuote_close + 2 * cuote_high, 6) AS upper FROM ({_events("1h")})""",
    "epoch_normalize": "SELECT event_id, date_trunc('second', ts) AS cuote_timestamp FROM events",
    "calendar_columns": f"SELECT o_orderkey, {_CALENDAR} FROM (SELECT *, o_orderdate AS cuote_timestamp FROM orders)",
    "csv_bar_scan": f"SELECT timeframe, {_CALENDAR}, {_BAR} FROM ({_events('1h')})",
    "archive_scan": f"""SELECT timeframe, strftime(cuote_timestamp, '%Y-%m') AS period, {_CALENDAR}, {_BAR} FROM ({_all(_orders, ["1d", "1w"])})""",
    "archive_scan_since": f"""SELECT timeframe, strftime(cuote_timestamp, '%Y-%m') AS period, {_BAR} FROM ({_all(_orders, ["1d", "1w"])})
        WHERE cuote_timestamp >= TIMESTAMP '1997-01-01'""",
    "zip_archive_scan": f"SELECT timeframe, strftime(cuote_timestamp, '%Y-%m-%d') AS period, {_BAR} FROM ({_events('30m')})",
    "bad_rows": "SELECT event_type || ',' || event_id AS line FROM events WHERE event_type = 'error'",
    "dedup_bars": f"SELECT timeframe, strftime(cuote_timestamp, '%Y-%m-%d') AS period, {_BAR} FROM ({_all(_events)})",
    "last_timestamp": f"""SELECT "index", timeframe, max(cuote_timestamp) AS last_timestamp FROM ({_all(_orders, ["1d", "1w"])}) GROUP BY 1, 2""",
    "partitioned_append": f"""SELECT store, CAST(cuote_timestamp AS DATE) AS cuote_date, {_BAR} FROM ({_events("4h")}) CROSS JOIN {_TWO_STORES}""",
    "table_scan": _DAILY,
    "read_market": f"SELECT {_BAR} FROM ({_events('1h')}) WHERE \"index\" = 'click'",
    "filter_symbol": f"SELECT {_BAR} FROM ({_events('15m')}) WHERE \"index\" = 'view'",
    "timeframe_route": f"""SELECT "index", timeframe, cuote_timestamp, CASE timeframe {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TABLES.items())} END AS "table"
        FROM ({_all(_events)})""",
    "last_partition_read": f"""SELECT {_BAR} FROM ({_events("1h")}) QUALIFY CAST(cuote_timestamp AS DATE) = max(CAST(cuote_timestamp AS DATE)) OVER (PARTITION BY "index")
        UNION ALL SELECT {_BAR} FROM ({_orders("1d")}) QUALIFY date_trunc('month', cuote_timestamp) = max(date_trunc('month', cuote_timestamp)) OVER (PARTITION BY "index")""",
    "high_water_mark": f"""SELECT "index", max(cuote_timestamp) AS mark FROM ({_events("1h")}) GROUP BY 1
        UNION ALL SELECT "index", max(cuote_timestamp) AS mark FROM ({_orders("1d")}) GROUP BY 1""",
    "latest_row": f"""SELECT timeframe, {_BAR} FROM ({_all(_events)})
        QUALIFY row_number() OVER (PARTITION BY "index", timeframe ORDER BY cuote_timestamp DESC) = 1""",
    "latest_partition_date": 'SELECT event_type AS "index", CAST(max(ts) AS DATE) AS cuote_date FROM events GROUP BY 1',
    "latest_partition_ym": """SELECT "index", CAST(ym // 100 AS INTEGER) AS cuote_year, CAST(ym % 100 AS INTEGER) AS cuote_month FROM (
        SELECT o_orderpriority AS "index", max(year(o_orderdate) * 100 + month(o_orderdate)) AS ym FROM orders GROUP BY 1)""",
    "parse_partition_string": """SELECT o_orderkey, o_orderpriority AS "index",
        CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS cuote_date,
        CASE WHEN o_orderstatus = 'O' THEN CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) END AS year_month FROM orders""",
    "incremental_filter": f"""SELECT {_BAR} FROM ({_events("15m")}) b LEFT JOIN (
          SELECT "index" AS i, max(cuote_timestamp) AS mark FROM ({_events("15m")})
          WHERE cuote_timestamp < TIMESTAMP '{SPLIT}' AND "index" <> 'signup' GROUP BY 1) m ON i = "index"
        WHERE mark IS NULL OR cuote_timestamp > mark""",
    "table_inventory": f"""SELECT 'crypto' AS "database", '{TABLES["1h"]}' AS "table", event_type AS "index",
          count(DISTINCT CAST(ts AS DATE)) AS partitions, strftime(max(ts), '%Y-%m-%d') AS newest FROM events GROUP BY event_type
        UNION ALL SELECT 'crypto', '{TABLES["1d"]}', o_orderpriority, count(DISTINCT date_trunc('month', o_orderdate)),
          strftime(max(o_orderdate), '%Y-%m') FROM orders GROUP BY o_orderpriority""",
    "incremental_load": _HOURLY,
    "incremental_load_catalog": f"SELECT {_BAR} FROM ({_events('4h')})",
    "incremental_load_collection": f"SELECT timeframe, {_BAR} FROM ({_all(_events, COLLECTIONS)})",
    "full_reload": f"""SELECT store, {_BAR} FROM (
          SELECT * FROM ({_orders("1d")}) WHERE "index" <> '5-LOW'
          UNION ALL SELECT * REPLACE (cuote_timestamp - INTERVAL 365 DAY AS cuote_timestamp) FROM ({_orders("1d")}) WHERE "index" = '5-LOW')
        CROSS JOIN {_TWO_STORES}""",
    "load_all_timeframes": f"SELECT timeframe, {_BAR} FROM ({_all(_events)})",
    "upsert_replace": _NEWEST_ORDERS,
    "collection_replace": _NEWEST_ORDERS,
    "replace_by_key": f"""SELECT {_BAR} FROM (SELECT * REPLACE (CASE WHEN "index" = '2-HIGH' THEN 0.0::double ELSE volume END AS volume) FROM ({_orders("1d")}))""",
    "drop_symbol": f"""SELECT store, {_BAR} FROM ({_events("4h")}) CROSS JOIN {_TWO_STORES} WHERE "index" <> 'error'""",
    "compact_partitions": f"SELECT {_BAR}, CAST(1 AS BIGINT) AS files FROM ({_events('1h')})",
    "compact_catalogue": f"SELECT {_BAR}, CAST(1 AS BIGINT) AS files FROM ({_events('1h')})",
    "backfill_plan": _backfill(),
    "asset_catalog": """SELECT lower(c_mktsegment) || '_' || c_name AS id, 'C' || c_custkey AS symbol,
        split_part(lower(c_mktsegment) || '_' || c_name, '_', 1) AS exchange FROM customer""",
    "open_assets": "SELECT c_name AS _id, 'open' AS status FROM customer WHERE c_acctbal >= 0",
    "request_parse": f"SELECT o_orderkey, 'C' || o_custkey AS symbol, exchange, priority FROM ({_PAYLOAD}) WHERE valid",
    "request_route": f"SELECT o_orderkey, {_ROUTE} AS route FROM ({_PAYLOAD})",
    "request_priority": f"""SELECT o_orderkey, priority, row_number() OVER (ORDER BY priority DESC, o_orderdate, o_orderkey) AS position
        FROM ({_PAYLOAD}) WHERE {_ROUTE} = 'load'""",
    "dead_letter": f"SELECT o_orderkey, value FROM ({_PAYLOAD}) WHERE NOT valid",
    "stream_requests": f"""WITH routed AS (SELECT event_type AS symbol, CASE WHEN event_type = 'error' THEN 3 ELSE length(event_type) END AS priority,
          CASE user_id % 10 WHEN 0 THEN 'unsupported' WHEN 1 THEN 'rejected' ELSE 'accepted' END AS kind FROM events),
        served AS (SELECT symbol, max(priority) AS priority FROM routed WHERE kind = 'accepted' GROUP BY 1)
        SELECT 'round' AS kind, symbol, (row_number() OVER (ORDER BY priority DESC) + 2) // 3 AS n FROM served
        UNION ALL SELECT timeframe || ' bars', "index", count(*) FROM ({_all(_events)})
          WHERE "index" IN (SELECT symbol FROM served) GROUP BY 1, 2
        UNION ALL SELECT kind, CASE kind WHEN 'rejected' THEN '' ELSE symbol END, count(*) FROM routed GROUP BY 1, 2""",
    "request_retry": f"""WITH served AS (SELECT DISTINCT o_orderpriority AS symbol FROM ({_PAYLOAD}) WHERE {_ROUTE} = 'load'),
        tried AS (SELECT symbol, 'loaded' AS status, 1 AS n, 0 AS minute FROM served WHERE symbol <> '2-HIGH'
          UNION ALL SELECT symbol, unnest(['waiting', 'waiting', 'loaded']), unnest([1, 2, 3]), unnest([0, 5, 15]) FROM served WHERE symbol = '2-HIGH')
        SELECT 'try ' || status AS kind, symbol, n::BIGINT AS n FROM tried
        UNION ALL SELECT 'minute', symbol, minute FROM tried
        UNION ALL SELECT 'bars', "index", count(*) FROM ({_orders("1w")}) WHERE "index" IN (SELECT symbol FROM served) GROUP BY 2""",
    "stream_incremental_load": f"SELECT timeframe, {_BAR} FROM ({_all(_events)})",
    "stream_accounting": f"""SELECT timeframe, count(*) AS loaded, count(*) AS dropped, count(*) AS duplicates,
          (3 * sum(count(*)) OVER () + bad)::BIGINT AS seen, bad
        FROM ({_all(_events)}), (SELECT count(*) AS bad FROM events) GROUP BY timeframe, bad""",
}
