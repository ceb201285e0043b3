"""Bars and other documents in unpartitioned collections.

A collection is a folder of Parquet files without partition folders. Nothing is listed by
partition: what is newest is answered by the files' footers, rows of a symbol are found by
the files' statistics, which are narrow because every write is sorted by symbol and time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from candlemill.operators.dedup import upsert_replace
from candlemill.operators.marks import MARK, high_water_mark
from candlemill.schema import KEPT_FIELDS, collection_name
from candlemill.session import staged
from candlemill.sources.store import holds_data

MICROS = "cuote_micros"  # the bar's time as a number: footers answer for numbers, not for timestamps

BAR_DOCUMENT = T.StructType(
    [
        *KEPT_FIELDS,
        T.StructField("cuote_timestamp", T.TimestampType()),
        T.StructField("index", T.StringType()),
        T.StructField(MICROS, T.LongType()),
    ]
)


class Collection:
    """Documents below one path. `sorted_by` columns keep the files' statistics narrow."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, sorted_by: Sequence[str] = ()):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.sorted_by = list(sorted_by)

    def exists(self) -> bool:
        return holds_data(self.spark, self.path)

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def footers(self, column: str) -> DataFrame:
        """Number of documents and greatest `column` (a number or date), from the footers; no row is read.

        Only Spark's newer file sources push aggregates down, so this DataFrame belongs to a session of its own.
        """
        session = self.spark.newSession()
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        rows = session.read.schema(self.schema).parquet(self.path)
        return rows.agg(F.count("*").alias("n"), F.max(column).alias("newest"))

    def append(self, documents: DataFrame) -> None:
        """Add documents; columns that the collection does not have are left out."""
        rows = documents.select(*self.schema.fieldNames())
        if not self.sorted_by:
            rows.write.mode("append").parquet(self.path)
            return
        # Ranges also split a symbol that holds much of the rows. They are sampled first, from
        # written rows, so that the documents are computed (and observed) once.
        with staged(rows, "documents") as known:
            ordered = known.repartitionByRange(*self.sorted_by).sortWithinPartitions(*self.sorted_by)
            ordered.write.mode("append").parquet(self.path)

    def replace(self, updates: DataFrame, key: str | Sequence[str] = "_id", prefer: str | Sequence[str] = ()) -> None:
        """Replace documents by key, insert new ones; rewrites only files that hold one to be replaced.

        If `updates` holds a key more than once, the row with the greatest `prefer` wins. Updates without
        a key are inserted once. The new files are in place before the old ones go: a run that ends in
        between leaves old documents beside the new, and the next run with these keys mends it.
        """
        keys = [key] if isinstance(key, str) else list(key)
        with staged(updates.select(*self.schema.fieldNames()), "updates") as rows:
            if not self.exists():
                empty = self.spark.createDataFrame([], self.schema)
                self.append(upsert_replace(empty, rows, keys, prefer))
                return
            stored = self.read().select(*keys, F.col("_metadata.file_path").alias("__file"))
            hit = stored.join(rows.select(*keys).distinct(), keys, "left_semi").select("__file").distinct()
            files = [row[0] for row in hit.toLocalIterator()]  # names of files, no rows
            old = self.spark.read.schema(self.schema).parquet(*files) if files else self.spark.createDataFrame([], self.schema)
            with staged(upsert_replace(old, rows, keys, prefer), "replaced") as result:
                self.append(result)
        conf = self.spark._jsc.hadoopConfiguration()
        for name in files:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, False)


class CollectionStore:
    """One collection of bars per timeframe, `<root>/<database>/<collection>`."""

    def __init__(self, spark: SparkSession, root: str, database: str = "markets"):
        self.spark, self.root, self.database = spark, root.rstrip("/"), database

    def collection(self, timeframe: str) -> Collection:
        path = f"{self.root}/{self.database}/{collection_name(timeframe)}"
        return Collection(self.spark, path, BAR_DOCUMENT, ["index", "cuote_timestamp"])

    def read(self, timeframe: str) -> DataFrame:
        """All stored bars; empty if nothing is stored yet."""
        return self.collection(timeframe).read().drop(MICROS)

    def read_market(self, index: str, timeframe: str) -> DataFrame:
        """Bars of one symbol; files without it are skipped by their statistics."""
        return self.read(timeframe).where(F.col("index") == F.lit(index))

    def newest(self, timeframe: str) -> datetime | None:
        """Time of the newest bar of all symbols, from the footers."""
        collection = self.collection(timeframe)
        if not collection.exists():
            return None
        micros = collection.footers(MICROS).first()["newest"]
        return None if micros is None else self.spark.range(1).select(F.timestamp_micros(F.lit(micros))).first()[0]

    def marks(self, timeframe: str, symbols: DataFrame | None = None, since: datetime | None = None) -> DataFrame:
        """High-water mark per symbol; with `since` only of symbols that have bars from then on.

        `since` reaches the scan, so that files of older bars alone are skipped.
        """
        bars = self.read(timeframe)
        if since is not None:
            bars = bars.where(F.col("cuote_timestamp") >= F.lit(since))
        if symbols is not None:
            bars = bars.join(symbols.select("index").distinct(), "index", "left_semi")
        return high_water_mark(bars).where(F.col(MARK).isNotNull())

    def append(self, timeframe: str, bars: DataFrame) -> None:
        self.collection(timeframe).append(bars.withColumn(MICROS, F.unix_micros("cuote_timestamp")))

    def replace(self, timeframe: str, bars: DataFrame, prefer: str | Sequence[str] = ()) -> None:
        """Replace bars by symbol and time, insert new ones."""
        documents = bars.withColumn(MICROS, F.unix_micros("cuote_timestamp"))
        self.collection(timeframe).replace(documents, ["index", "cuote_timestamp"], prefer)
