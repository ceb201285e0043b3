"""Bars from zipped CSV archives."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlemill.sources.csv_bars import records_of_lines

_LINES_PER_BATCH = 20_000


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of the CSV members, in batches of bounded size.

    An archive that can't be read, to its end or at all, or holds no CSV, gives a line that says so,
    which is no record and so becomes a bad row under the archive's name.
    """
    for batch in batches:
        for name, content in zip(batch["file_name"], batch["content"]):
            try:
                yield from _lines(name, content)
            except (zipfile.BadZipFile, zlib.error, EOFError, UnicodeDecodeError, NotImplementedError, RuntimeError) as e:
                yield pd.DataFrame({"file_name": [name], "line": [f"unreadable archive: {type(e).__name__}"]})


def _lines(name: str, content: bytes) -> Iterator[pd.DataFrame]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        members = [m for m in archive.namelist() if m.endswith(".csv")]
        if not members:
            yield pd.DataFrame({"file_name": [name], "line": ["archive without a CSV member"]})
        for member in members:
            with archive.open(member) as raw:
                lines: list[str] = []
                for line in io.TextIOWrapper(raw, encoding="utf-8"):
                    lines.append(line.rstrip("\r\n"))
                    if len(lines) == _LINES_PER_BATCH:
                        yield pd.DataFrame({"file_name": name, "line": lines})
                        lines = []
                if lines:
                    yield pd.DataFrame({"file_name": name, "line": lines})


def read_zip_records(spark: SparkSession, path: str, since_period: str | None = None) -> DataFrame:
    """Same columns as `read_records`, from `<symbol>-<timeframe>-<period>.zip` files.

    Archives are spread over tasks by size; one archive covers one period of one
    series and is unpacked by one task, line by line.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "content")
    )
    if since_period is not None:
        period = F.regexp_extract("file_name", r"-(\d{4}-\d{2})(?:-\d{2})?\.zip$", 1)
        files = files.where((period == "") | (period >= since_period))
    return records_of_lines(files.mapInPandas(_unpack, "file_name string, line string"))
