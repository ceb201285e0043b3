"""Stored bars, one partitioned Parquet table per timeframe.

`PathStore` keeps the tables below a root folder, `CatalogStore` in the session
catalogue. Both offer the same operations, so the load pipelines take either.
"""

from __future__ import annotations

import uuid
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from candlemill.functions.text import partition_date, partition_symbol, partition_year_month, url_decoded
from candlemill.operators.marks import (
    MARK,
    high_water_mark,
    latest_partition_date,
    latest_partition_year_month,
)
from candlemill.schema import (
    DATABASE,
    DAY_PARTITIONS,
    KEPT_FIELDS,
    TIMEFRAMES,
    partition_columns,
    partition_fields,
    stored_schema,
    table_name,
)
from candlemill.session import written

_BROADCAST_ROWS = 1_000_000  # of a symbol and a date: some tens of megabytes
_STATEMENT_PARTITIONS = 500
_REWRITTEN = "_rewritten-"  # folders of compacted files; listings of the table's folder pass over them
_NAMED_SYMBOLS = 1_000  # symbols whose folders are listed one by one

_LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def _partition_label(timeframe: str) -> Column:
    """yyyy-MM-dd or yyyy-MM, which sort by time."""
    if partition_columns(timeframe) == DAY_PARTITIONS:
        return F.col("cuote_date").cast("string")
    return F.format_string("%04d-%02d", "cuote_year", "cuote_month")


def holds_data(spark: SparkSession, location: str) -> bool:
    """Whether a Parquet file lies below; ends at the first one found."""
    root = spark._jvm.org.apache.hadoop.fs.Path(location)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return False
    found = fs.listFiles(root, True)
    while found.hasNext():
        path = found.next().getPath().toString()
        if path.endswith(".parquet") and "/_" not in path[len(location) :]:
            return True
    return False


class BarStore:
    """What both stores share."""

    def __init__(self, spark: SparkSession, database: str = DATABASE):
        self.spark = spark
        self.database = database

    # to be given by the subclass
    def exists(self, timeframe: str) -> bool:
        raise NotImplementedError

    def _read(self, timeframe: str) -> DataFrame:
        raise NotImplementedError

    def _append(self, timeframe: str, rows: DataFrame) -> None:
        raise NotImplementedError

    def _partitions(self, timeframe: str, symbols: list[str] | None = None) -> DataFrame:
        raise NotImplementedError

    def overwrite_partitions(self, timeframe: str, rows: DataFrame) -> None:
        """Replace every partition that `rows` touches, leave the others."""
        raise NotImplementedError

    def drop_partitions(self, timeframe: str, partitions: DataFrame) -> None:
        """Remove whole partitions, given by their partition columns."""
        raise NotImplementedError

    def file_counts(self, timeframe: str) -> DataFrame:
        """Number of data `files` per partition."""
        raise NotImplementedError

    def rewrite_partitions(self, timeframe: str, partitions: DataFrame, remove_replaced: bool = False) -> None:
        """Write the given partitions (distinct; a written table) anew, each as one file.

        `remove_replaced` deletes the old files where the rewrite itself does not.
        """
        raise NotImplementedError

    # shared
    def drop_symbols(self, timeframe: str, symbols: list[str]) -> None:
        """Remove all partitions of the symbols."""
        self.drop_partitions(timeframe, written(self.partitions(timeframe, symbols), "drop"))

    def read(self, timeframe: str) -> DataFrame:
        """All stored bars; empty if nothing is stored yet."""
        if not self.exists(timeframe):
            return self.spark.createDataFrame([], stored_schema(timeframe))
        return self._read(timeframe)

    def read_market(self, index: str, timeframe: str) -> DataFrame:
        """Bars of one symbol; reads only its partitions."""
        return self.read(timeframe).where(F.col("index") == F.lit(index))

    def partitions(self, timeframe: str, symbols: list[str] | None = None) -> DataFrame:
        """Partition values, of all symbols or of those named, without opening a data file."""
        if not self.exists(timeframe):
            return self.spark.createDataFrame([], T.StructType(partition_fields(timeframe)))
        return self._partitions(timeframe, symbols)

    def read_partitions(self, timeframe: str, partitions: DataFrame) -> DataFrame:
        """Bars in the given partitions (distinct; a written table, as it is read twice).

        The bounds of their dates go into the scan as plain filters, which prunes whatever their number. Up to
        `_BROADCAST_ROWS` of them are broadcast and prune to exactly these partitions; beyond, they join by shuffle.
        """
        keys = list(partition_columns(timeframe))
        count, low, high = partitions.agg(F.count(F.lit(1)), F.min(keys[1]), F.max(keys[1])).first()
        bars = self.read(timeframe)
        if low is None:
            return bars.where(F.lit(False))
        bars = bars.where(F.col(keys[1]).between(F.lit(low), F.lit(high)))
        return bars.join(F.broadcast(partitions) if count <= _BROADCAST_ROWS else partitions, keys, "left_semi")

    def newest_partitions(self, timeframe: str, symbols: list[str] | None = None) -> DataFrame:
        """Newest partition of every symbol, or of those named."""
        partitions = self.partitions(timeframe, symbols)
        if "cuote_date" in partition_columns(timeframe):
            return latest_partition_date(partitions)
        return latest_partition_year_month(partitions)

    def read_last_partitions(self, timeframe: str, symbols: DataFrame | None = None) -> DataFrame:
        """Bars in the newest partition of every symbol, or of those in `symbols`.

        The newest partitions come from the listing and are written down, one small row per symbol.
        Of a few symbols only their own folders are listed.
        """
        if not self.exists(timeframe):
            return self.read(timeframe)
        names = None
        if symbols is not None:
            symbols = symbols.select("index").distinct()
            some = [row[0] for row in symbols.limit(_NAMED_SYMBOLS + 1).collect()]
            names = [n for n in some if n is not None] if len(some) <= _NAMED_SYMBOLS else None
        newest = self.newest_partitions(timeframe, names)
        if symbols is not None:
            newest = newest.join(symbols, "index", "left_semi")
        return self.read_partitions(timeframe, written(newest, "newest"))

    def marks(self, timeframe: str, symbols: DataFrame | None = None) -> DataFrame:
        """High-water mark per symbol, read from newest partitions only."""
        return high_water_mark(self.read_last_partitions(timeframe, symbols)).where(F.col(MARK).isNotNull())

    def layout(self, timeframe: str, bars: DataFrame) -> DataFrame:
        """Columns of the stored table, rows of one partition brought together.

        One file per partition and write. A partition holds a day (or month) of one
        symbol, so its rows are few; what costs is the number of files, which is
        why they are spread over all tasks instead of merged by size.
        """
        keys = partition_columns(timeframe)
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        columns = [f.name for f in KEPT_FIELDS] + ["cuote_timestamp", *keys]
        return bars.select(*columns).repartition(tasks, *keys)

    def append(self, timeframe: str, bars: DataFrame) -> None:
        self._append(timeframe, self.layout(timeframe, bars))

    def inventory(self) -> DataFrame:
        """One row per table and symbol: number of partitions and newest partition."""
        parts = [
            self.partitions(t).select(
                F.lit(self.database).alias("database"),
                F.lit(table_name(t)).alias("table"),
                "index",
                _partition_label(t).alias("partition"),
            )
            for t in TIMEFRAMES
            if self.exists(t)
        ]
        if not parts:
            return self.spark.createDataFrame(
                [], "database string, table string, index string, partitions bigint, newest string"
            )
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more)
        return (
            rows.distinct()
            .groupBy("database", "table", "index")
            .agg(F.count(F.lit(1)).alias("partitions"), F.max("partition").alias("newest"))
        )


class PathStore(BarStore):
    """Tables as folders `<root>/<database>/<table>`."""

    def __init__(self, spark: SparkSession, root: str, database: str = DATABASE):
        super().__init__(spark, database)
        self.root = root.rstrip("/")

    def location(self, timeframe: str) -> str:
        return f"{self.root}/{self.database}/{table_name(timeframe)}"

    def exists(self, timeframe: str) -> bool:
        """Judged by the first data file found, not by a catalogue entry or an empty folder."""
        return holds_data(self.spark, self.location(timeframe))

    def _read(self, timeframe: str) -> DataFrame:
        return self.spark.read.schema(stored_schema(timeframe)).parquet(self.location(timeframe))

    def folders(self, timeframe: str, symbols: list[str]) -> list[str]:
        """The folders of the symbols, of those that have one; nothing else is listed."""
        jvm, found = self.spark._jvm, []
        for symbol in symbols:
            name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString("index", symbol)
            path = jvm.org.apache.hadoop.fs.Path(self.location(timeframe), name)
            if path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
                found.append(path.toString())
        return found

    def drop_symbols(self, timeframe: str, symbols: list[str]) -> None:
        """Remove the folders of the symbols, one call each."""
        conf = self.spark._jsc.hadoopConfiguration()
        for folder in self.folders(timeframe, symbols):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)

    def read_market(self, index: str, timeframe: str) -> DataFrame:
        """Bars of one symbol; only its folder is listed and read."""
        folders = self.folders(timeframe, [index])
        if not folders:
            return self.spark.createDataFrame([], stored_schema(timeframe))
        reader = self.spark.read.schema(stored_schema(timeframe)).option("basePath", self.location(timeframe))
        return reader.parquet(*folders).where(F.col("index") == F.lit(index))

    def files(self, timeframe: str, symbols: list[str] | None = None) -> DataFrame:
        """Data files and their partition values from the listing, of all symbols or of those named; no file is opened."""
        schema = T.StructType(_LISTING.fields + partition_fields(timeframe))
        folders = [self.location(timeframe)] if symbols is None else self.folders(timeframe, symbols)
        if not folders:
            return self.spark.createDataFrame([], schema).drop("content")
        reader = self.spark.read.format("binaryFile").schema(schema).option("pathGlobFilter", "*.parquet")
        return reader.option("basePath", self.location(timeframe)).load(folders).drop("content")

    def file_counts(self, timeframe: str) -> DataFrame:
        """From the listing; no file is opened."""
        return self.files(timeframe).groupBy(*partition_columns(timeframe)).agg(F.count(F.lit(1)).alias("files"))

    def rewrite_partitions(self, timeframe: str, partitions: DataFrame, remove_replaced: bool = False) -> None:
        self.overwrite_partitions(timeframe, self.read_partitions(timeframe, partitions))

    def _partitions(self, timeframe: str, symbols: list[str] | None = None) -> DataFrame:
        return self.files(timeframe, symbols).select(*partition_columns(timeframe)).distinct()

    def _append(self, timeframe: str, rows: DataFrame) -> None:
        keys = partition_columns(timeframe)
        rows.write.partitionBy(*keys).mode("append").parquet(self.location(timeframe))

    def overwrite_partitions(self, timeframe: str, rows: DataFrame) -> None:
        (
            self.layout(timeframe, rows)
            .write.partitionBy(*partition_columns(timeframe))
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(self.location(timeframe))
        )

    def drop_partitions(self, timeframe: str, partitions: DataFrame) -> None:
        keys = list(partition_columns(timeframe))
        folders = (
            self.files(timeframe)
            .join(partitions.select(*keys), keys, "left_semi")
            .select(F.regexp_replace("path", "/[^/]+$", "").alias("folder"))
            .distinct()
        )
        conf = self.spark._jsc.hadoopConfiguration()
        for row in folders.toLocalIterator():  # folder names only, one at a time
            path = self.spark._jvm.org.apache.hadoop.fs.Path(row.folder)
            path.getFileSystem(conf).delete(path, True)


class CatalogStore(BarStore):
    """Tables `<database>.<table>` of the session catalogue."""

    def __init__(self, spark: SparkSession, database: str = DATABASE, location: str | None = None):
        super().__init__(spark, database)
        where = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")

    def table(self, timeframe: str) -> str:
        return f"{self.database}.{table_name(timeframe)}"

    def exists(self, timeframe: str) -> bool:
        return self.spark.catalog.tableExists(self.table(timeframe))

    def _read(self, timeframe: str) -> DataFrame:
        return self.spark.table(self.table(timeframe))

    def partition_strings(self, timeframe: str) -> DataFrame:
        return self.spark.sql(f"SHOW PARTITIONS {self.table(timeframe)}")

    def _partitions(self, timeframe: str, symbols: list[str] | None = None) -> DataFrame:
        shown = self.partition_strings(timeframe).withColumn("index", url_decoded(partition_symbol("partition")))
        if symbols is not None:
            shown = shown.where(F.col("index").isin(symbols))
        if "cuote_date" in partition_columns(timeframe):
            return shown.select("index", partition_date("partition").alias("cuote_date"))
        ym = partition_year_month("partition")
        return shown.select(
            "index", F.floor(ym / 100).cast("int").alias("cuote_year"), (ym % 100).cast("int").alias("cuote_month")
        )

    def _append(self, timeframe: str, rows: DataFrame) -> None:
        keys = partition_columns(timeframe)
        rows.write.partitionBy(*keys).format("parquet").mode("append").saveAsTable(self.table(timeframe))

    def overwrite_partitions(self, timeframe: str, rows: DataFrame) -> None:
        if not self.exists(timeframe):
            self.append(timeframe, rows)
            return
        # insertInto goes by position; the layout has the order of the table. Unlike a
        # write to a path it takes the mode from the session only.
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            self.layout(timeframe, rows).write.mode("overwrite").insertInto(self.table(timeframe))
        finally:
            self.spark.conf.set(mode, before)

    def _data_files(self, timeframe: str) -> DataFrame:
        """Distinct data files that partitions point to, with the partition values; reads no column of the data."""
        path = F.col("_metadata.file_path").alias("path")
        return self._read(timeframe).select(*partition_columns(timeframe), path).distinct()

    def file_counts(self, timeframe: str) -> DataFrame:
        return self._data_files(timeframe).groupBy(*partition_columns(timeframe)).agg(F.count(F.lit(1)).alias("files"))

    def location(self, timeframe: str) -> str:
        described = self.spark.sql(f"DESCRIBE FORMATTED {self.table(timeframe)}")
        return described.where("col_name = 'Location'").head().data_type

    def rewrite_partitions(self, timeframe: str, partitions: DataFrame, remove_replaced: bool = False) -> None:
        """Complete new files first, then one change of the catalogue per partition; replaced files go last, if at all."""
        keys = partition_columns(timeframe)
        base = f"{self.location(timeframe)}/{_REWRITTEN}{uuid.uuid4().hex}"
        bars = self.layout(timeframe, self.read_partitions(timeframe, partitions))
        bars.write.partitionBy(*keys).parquet(base)
        schema = T.StructType(_LISTING.fields + partition_fields(timeframe))
        listed = self.spark.read.format("binaryFile").schema(schema).option("pathGlobFilter", "*.parquet").load(base)
        folders = written(listed.select(*keys, _folder("path").alias("folder")).distinct(), "folders")
        conf = self.spark._jsc.hadoopConfiguration()
        for row in folders.toLocalIterator():  # partition values and folder names only
            table = f"{self.table(timeframe)} PARTITION (" + ", ".join(f"{k} = {_literal(row[k])}" for k in keys) + ")"
            before = self._partition_folder(table)
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(row.folder)}")
            if remove_replaced:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(before)
                path.getFileSystem(conf).delete(path, True)

    def _partition_folder(self, table_partition: str) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table_partition}")
        return described.where("col_name = 'Location'").head().data_type

    def drop_partitions(self, timeframe: str, partitions: DataFrame) -> None:
        keys = partition_columns(timeframe)
        rows = partitions.select(*keys).distinct().toLocalIterator()  # partition values only
        for some in iter(lambda: list(islice(rows, _STATEMENT_PARTITIONS)), []):
            specs = ", ".join(
                "PARTITION (" + ", ".join(f"{k} = {_literal(row[k])}" for k in keys) + ")" for row in some
            )
            self.spark.sql(f"ALTER TABLE {self.table(timeframe)} DROP IF EXISTS {specs}")


def _folder(column: str) -> Column:
    return F.regexp_replace(column, "/[^/]+$", "")


def _literal(value: object) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def read_table(
    spark: SparkSession, name: str, format: str = "parquet", schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """A whole table or collection by path or catalogue name, from any installed format.

    Give a `schema` where partition values look like numbers: a symbol `0123` is read as 123 without.
    """
    reader = spark.read.format(format).options(**options)
    reader = reader if schema is None else reader.schema(schema)
    if "/" in name:
        return reader.load(name)
    try:
        return spark.table(name)
    except AnalysisException:
        return reader.load(name)
