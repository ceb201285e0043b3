"""One bar per (series, time), and replacing rows by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _winner(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column], copies: str | None = None) -> DataFrame:
    """The row with the greatest `prefer`, ties settled by the other columns; `copies` names a column for their number.

    A maximum of structs is combined before the shuffle: a key with very many
    copies reaches its task as one row per input partition.
    """
    others = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(prefer)], F.struct(*others).alias("row")))
    number = [] if copies is None else [copies]
    rows = df.groupBy(*keys).agg(best.alias("best"), *[F.count(F.lit(1)).alias(c) for c in number])
    return rows.select(*keys, "best.row.*", *number).select(*df.columns, *number)


def dedup_bars(
    df: DataFrame,
    keys: Sequence[str] = ("index", "timeframe", "cuote_timestamp"),
    prefer: str | Sequence[str] = "period",
    copies: str | None = None,
) -> DataFrame:
    """Keep one bar per key: that of the latest archive period (NULL comes first).

    `copies` names a column for the number of rows each stands for.
    """
    prefer = [prefer] if isinstance(prefer, str) else list(prefer)
    return _winner(df, keys, [F.col(p) for p in prefer], copies)


def latest_row(df: DataFrame, partition_cols: Sequence[str] = ("index",), order_col: str = "cuote_timestamp") -> DataFrame:
    """The newest bar of every series."""
    return _winner(df, partition_cols, [F.col(order_col)])


def upsert_replace(
    target: DataFrame, updates: DataFrame, key: str | Sequence[str] = "_id", prefer: str | Sequence[str] = ()
) -> DataFrame:
    """Rows of `target`, with those replaced whose key is in `updates`; new keys are added.

    If `updates` holds a key more than once, the row with the greatest `prefer` wins.
    """
    keys = [key] if isinstance(key, str) else list(key)
    prefer = [prefer] if isinstance(prefer, str) else list(prefer)
    winners = _winner(updates, keys, [F.col(p) for p in prefer])
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(winners)
