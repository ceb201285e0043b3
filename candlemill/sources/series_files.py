"""The archive files of some symbols, found by their names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from candlemill.sources.csv_bars import as_bars, named_lines, records_of_lines

_NO_LINES = "line string, file_name string"


class SeriesFiles:
    """CSV archives `<symbol>-<timeframe>[-<period>].csv` of one folder.

    Only files of the symbols and the timeframe that are asked for are opened; the folder is
    listed by the file system, once per question.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def paths(self, symbols: Sequence[str], timeframe: str) -> list[str]:
        """Names of the files; a symbol without any has none."""
        if not symbols:
            return []
        # A name is matched as it stands, whatever characters it holds.
        names = ",".join(re.sub(r"([\\{}\[\]*?,^])", r"\\\1", s) for s in symbols)
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{{{names}}}-{timeframe}{{.csv,-*.csv}}")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern)
        return sorted(status.getPath().toString() for status in found or [])

    def records(self, symbols: Sequence[str], timeframe: str) -> DataFrame:
        """Records as `read_records` gives them; empty if there is no file."""
        paths = self.paths(symbols, timeframe)
        if not paths:
            return records_of_lines(self.spark.createDataFrame([], _NO_LINES))
        return records_of_lines(named_lines(self.spark.read.text(paths)))

    def bars(self, symbols: Sequence[str], timeframe: str) -> DataFrame:
        return as_bars(self.records(symbols, timeframe))
