"""Loading bars into a store: incremental, full reload, replace by key, drop."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, functions as F

from candlemill.functions.temporal import calendar_columns
from candlemill.operators.dedup import dedup_bars, upsert_replace
from candlemill.operators.marks import MARK, is_newer, with_marks
from candlemill.schema import TIMEFRAMES, partition_columns
from candlemill.session import staged, written
from candlemill.sources.collection import CollectionStore
from candlemill.sources.store import BarStore


def _one_each(bars: DataFrame) -> DataFrame:
    """One bar per symbol and time, with the columns that place it in a partition."""
    if "period" not in bars.columns:
        bars = bars.withColumn("period", F.lit(None).cast("string"))
    return dedup_bars(bars, ["index", "cuote_timestamp"], "period").withColumns(calendar_columns())


def _loadable() -> Column:
    return F.col("index").isNotNull() & F.col("cuote_timestamp").isNotNull() & is_newer()


def _metric(seen: Observation, name: str) -> int | None:
    """NULL if Spark found a stage empty at run time and cut the observed part from its plan."""
    try:
        return seen.get[name]
    except Py4JJavaError:
        return None


def load_incremental(
    store: BarStore, bars: DataFrame, timeframe: str, symbols: DataFrame | None = None
) -> dict[str, int]:
    """Append the bars newer than the mark of their symbol, all symbols in one job.

    With `symbols` only their bars are loaded and only their marks are read, which
    pays when a few of many stored symbols are loaded.

    Bars at or before the mark, and bars without symbol or time, which no mark could ever
    hold back, are dropped before anything is shuffled. Running it twice, or again after a
    failure, adds nothing. Returns the numbers of `loaded` bars and of `dropped` records.
    """
    if symbols is not None:
        bars = bars.join(symbols.select("index").distinct(), "index", "left_semi")
    return _append_newer(store, bars, timeframe, store.marks(timeframe, symbols))


def _append_newer(store: BarStore | CollectionStore, bars: DataFrame, timeframe: str, marks: DataFrame) -> dict[str, int]:
    late, fresh = Observation(), Observation()
    marked = with_marks(bars, marks)
    newer = marked.observe(late, F.count_if(~_loadable()).alias("n")).where(_loadable()).drop(MARK)
    store.append(timeframe, _one_each(newer).observe(fresh, F.count(F.lit(1)).alias("n")))
    loaded, dropped = _metric(fresh, "n") or 0, _metric(late, "n")
    if dropped is None:  # nothing was loaded, so the marks are still the same
        dropped = marked.where(~_loadable()).count()
    return {"loaded": loaded, "dropped": dropped}


def load_accounted(
    store: BarStore, bars: DataFrame, timeframe: str, dedup_within: str | None = None, symbols: DataFrame | None = None
) -> dict[str, int]:
    """`load_incremental` that accounts for every bar: returns `loaded`, `dropped` and `duplicates`, which add up to all.

    Duplicates are copies of a bar that is loaded and, with `dedup_within` (an interval, say "2 days"), bars
    that are stored already and not older than that before their symbol's mark. Other bars at or before
    the mark, and bars without symbol or time, are dropped.

    What became of each bar is written down once; loading and counting both read that.
    """
    if symbols is not None:
        bars = bars.join(symbols.select("index").distinct(), "index", "left_semi")
    marks = written(store.marks(timeframe, symbols), "marks")
    if "period" not in bars.columns:
        bars = bars.withColumn("period", F.lit(None).cast("string"))
    key = ["index", "cuote_timestamp"]
    named = F.col("index").isNotNull() & F.col("cuote_timestamp").isNotNull()
    # Bars without symbol or time are one group, of which there are as many copies.
    rows = with_marks(dedup_bars(bars, key, "period", "copies").withColumns(calendar_columns()), marks)
    late = F.lit(True) if dedup_within is None else F.lit(False)
    if dedup_within is not None:
        window = F.col(MARK) - F.expr(f"interval {dedup_within}")
        oldest = marks.agg(F.min(window)).first()[0]
        known = store.read(timeframe)
        if oldest is not None:
            known = known.where((F.col("cuote_timestamp") >= F.lit(oldest)) & _not_before(timeframe, oldest))
        known = known.select(*key).withColumn("stored", F.lit(True)).distinct()
        rows = rows.join(known, key, "left")
        late = F.col("stored").isNull() | (F.col("cuote_timestamp") < window)
    outcome = F.when(named & is_newer(), "loaded").when(late | ~named, "dropped").otherwise("duplicates")
    rows = rows.withColumn("outcome", outcome).drop(MARK, "stored")
    with staged(rows, "accounted", "outcome") as known:
        copies = {r["outcome"]: (r["n"], r["copies"]) for r in known.groupBy("outcome").agg(F.count("*").alias("n"), F.sum("copies").alias("copies")).collect()}
        loaded, seen = copies.get("loaded", (0, 0))
        if loaded:
            store.append(timeframe, known.where(F.col("outcome") == "loaded"))
    duplicates = seen - loaded + copies.get("duplicates", (0, 0))[1]
    return {"loaded": loaded, "dropped": copies.get("dropped", (0, 0))[1], "duplicates": duplicates}


def _not_before(timeframe: str, time: datetime) -> Column:
    """What partitions of bars from `time` on have in common, as a plain bound."""
    column = partition_columns(timeframe)[1]
    return F.col(column) >= F.lit(time.date() if column == "cuote_date" else time.year)


def load_collection(store: CollectionStore, bars: DataFrame, timeframe: str, replace: bool = False) -> dict[str, int]:
    """Append the bars newer than the mark of their symbol to a collection; `load_incremental` without partitions.

    The newest bar of all comes from the files' footers. Bars that are newer still need no mark, so if
    all are, no stored row is read. Otherwise marks are read from the oldest of the bars on: a
    symbol without stored bars since then has no bar that could be held back.

    With `replace` all bars are taken, stored ones of the same symbol and time replaced.
    """
    with staged(bars, "collection") as rows:
        if replace:
            good = F.col("index").isNotNull() & F.col("cuote_timestamp").isNotNull()
            winners = _one_each(rows.where(good))
            store.replace(timeframe, winners)
            return {"loaded": winners.count(), "dropped": rows.where(~good).count()}
        newest, oldest = store.newest(timeframe), rows.agg(F.min("cuote_timestamp")).first()[0]
        if newest is None or oldest is None or oldest > newest:
            marks = store.spark.createDataFrame([], "index string, mark timestamp")
        else:
            marks = store.marks(timeframe, rows.select("index"), since=oldest)
        return _append_newer(store, rows, timeframe, marks)


def load_all_timeframes(
    store: BarStore,
    bars: DataFrame | Mapping[str, DataFrame],
    timeframes: Sequence[str] = TIMEFRAMES,
    symbols: DataFrame | None = None,
) -> dict[str, dict[str, int]]:
    """`load_incremental` for every timeframe.

    Give a mapping of timeframe to its bars when each has its own files, so that
    every job reads only those. A single DataFrame is computed once and staged by
    timeframe; bars of none of the timeframes, if any, are counted as dropped under `other`.
    """
    if isinstance(bars, Mapping):
        return {t: load_incremental(store, bars[t], t, symbols) for t in timeframes}
    with staged(bars, "timeframes", "timeframe") as rows:
        counts = {t: load_incremental(store, rows.where(F.col("timeframe") == t), t, symbols) for t in timeframes}
        other = rows.where(F.col("timeframe").isNull() | ~F.col("timeframe").isin(*timeframes)).count()
    return counts | ({"other": {"loaded": 0, "dropped": other}} if other else {})


def full_reload(store: BarStore, bars: DataFrame, timeframe: str) -> None:
    """Replace everything stored of the symbols in `bars`.

    The new partitions are in place before old ones that have no successor are
    removed, so a failure in between leaves no symbol empty; a second run mends it.
    """
    keys = list(partition_columns(timeframe))
    before = written(store.partitions(timeframe), "before")
    with staged(_one_each(bars), "reload") as rows:
        after = written(rows.select(*keys).distinct(), "after")
        store.overwrite_partitions(timeframe, rows)
    symbols = after.select("index").distinct()
    stale = before.join(symbols, "index", "left_semi").join(after, keys, "left_anti")
    store.drop_partitions(timeframe, stale)


def drop_symbols(store: BarStore, timeframe: str, symbols: Sequence[str]) -> None:
    """Remove everything stored of the given symbols."""
    if store.exists(timeframe):
        store.drop_symbols(timeframe, list(symbols))


def replace_by_key(
    store: BarStore, updates: DataFrame, timeframe: str, key: Sequence[str] = ("index", "cuote_timestamp")
) -> None:
    """Replace stored rows by key, insert new keys; rewrites only touched partitions.

    Touched are the partitions of the updates and those that hold a row to be
    replaced. A key with symbol and time tells its partition, so only these partitions are read; for other
    keys the table is searched first. A partition whose last row moves elsewhere is removed.
    """
    keys = list(partition_columns(timeframe))
    with staged(updates.withColumns(calendar_columns()), "updates") as news:
        touched = news.select(*keys)
        if not {"index", "cuote_timestamp"} <= set(key):
            replaced = store.read(timeframe).join(news.select(*key).distinct(), list(key), "left_semi")
            touched = touched.union(replaced.select(*keys))
        touched = written(touched.distinct(), "touched")
        stored = store.read_partitions(timeframe, touched)
        rows = written(upsert_replace(stored, news.select(*stored.columns), key), "replaced")
    store.overwrite_partitions(timeframe, rows)
    store.drop_partitions(timeframe, touched.join(rows.select(*keys).distinct(), keys, "left_anti"))
