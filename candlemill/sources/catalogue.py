"""Asset lists and load requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlemill.functions.text import REQUEST_SCHEMA, exchange_of, request_fields

# Fixed value: exchanges that have a loader.
SUPPORTED_EXCHANGES = ("binance",)


def read_assets(spark: SparkSession, path: str, one_document: bool = False) -> DataFrame:
    """Asset list of `{"id": "<exchange>_...", "symbol": ...}`.

    One object per line, or with `one_document` a single JSON array per file.
    """
    return asset_catalog(spark.read.schema("id string, symbol string").option("multiLine", one_document).json(path))


def asset_catalog(assets: DataFrame) -> DataFrame:
    """Adds `exchange`, the text of `id` before the first underscore."""
    return assets.withColumn("exchange", exchange_of("id"))


def open_assets(assets: DataFrame) -> DataFrame:
    return assets.where(F.col("status") == F.lit("open"))


def parse_requests(raw: DataFrame, payload: str = "value") -> DataFrame:
    """Adds symbol, exchange, priority and `valid` to rows that hold a request's JSON text."""
    # inline() keeps later filters above the parser, so a text is parsed once.
    decoded = raw.select("*", F.inline(F.array(F.from_json(payload, REQUEST_SCHEMA, {"mode": "PERMISSIVE"}))))
    checked = request_fields(*[F.col(c) for c in ("symbol", "exchange", "priority", "_corrupt_record")])
    return decoded.withColumns(checked).drop("_corrupt_record")


def route_requests(parsed: DataFrame, supported: Sequence[str] = SUPPORTED_EXCHANGES) -> DataFrame:
    """Adds `route`: `load`, `unsupported` exchange, or `invalid` for a dead letter."""
    route = (
        F.when(~F.col("valid"), F.lit("invalid"))
        .when(F.col("exchange").isin(*supported), F.lit("load"))
        .otherwise(F.lit("unsupported"))
    )
    return parsed.withColumn("route", route)


def dead_letters(routed: DataFrame) -> DataFrame:
    """Requests that no run can serve."""
    return routed.where(F.col("route") == "invalid")
