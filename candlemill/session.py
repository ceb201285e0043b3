"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "candlemill", cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """A local session as tests and the bench use it; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Epoch numbers, calendar columns and partition values are all read in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's shared `spark.checkpoint.dir`.

    Only a local session without that setting (a laptop, a test) gets a local folder;
    a cluster has to name a shared one. The folder is dropped by the file system when the driver ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    path = f"{base.rstrip('/')}/candlemill-{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def local_path(path: str) -> str:
    """Shared POSIX folder as tasks and plain Python see it."""
    return path[5:] if path.startswith("file:") else os.path.abspath(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder; survives lost executors."""
    path = f"{scratch_dir(df.sparkSession, label)}/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str, *partition_by: str) -> Iterator[DataFrame]:
    """`written`, split into folders by the given columns if any, for as long as the block runs."""
    spark = df.sparkSession
    folder = scratch_dir(spark, label)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(f"{folder}/data")
    try:
        yield spark.read.schema(df.schema).parquet(f"{folder}/data")
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
