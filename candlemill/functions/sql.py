"""The scalar formulas as SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

# name -> (parameters, result type, expression)
SQL_FUNCTIONS = {
    "bar_division": (
        "num DOUBLE, denum DOUBLE",
        "DOUBLE",
        "CASE WHEN num IS NULL OR denum IS NULL THEN NULL WHEN denum > 0 AND NOT isnan(denum) THEN num / denum ELSE 0.0D END",
    ),
    "bar_gain": (
        "change DOUBLE",
        "DOUBLE",
        "CASE WHEN change > 0 AND NOT isnan(change) THEN change WHEN change IS NOT NULL THEN 0.0D END",
    ),
    "bar_loss": ("change DOUBLE", "DOUBLE", "CASE WHEN change < 0 THEN -change WHEN change IS NOT NULL THEN 0.0D END"),
    "bar_rsi": ("ratio DOUBLE", "DOUBLE", "CASE WHEN ratio = -1 THEN 0.0D ELSE 100.0D - 100.0D / (1.0D + ratio) END"),
    "bar_stochastic_k": (
        "close DOUBLE, highest DOUBLE, lowest DOUBLE",
        "DOUBLE",
        "CASE WHEN close IS NULL OR highest IS NULL OR lowest IS NULL THEN NULL "
        "WHEN highest - lowest > 0 AND NOT isnan(highest - lowest) THEN (close - lowest) / (highest - lowest) * 100 ELSE 0.0D END",
    ),
    "bar_band_lower": ("middle DOUBLE, deviation DOUBLE", "DOUBLE", "middle - 2.0D * deviation"),
    "bar_band_upper": ("middle DOUBLE, deviation DOUBLE", "DOUBLE", "middle + 2.0D * deviation"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the formulas callable from `spark.sql`; they inline into the plan."""
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return sorted(SQL_FUNCTIONS)
