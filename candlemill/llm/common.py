"""Helpers the corpus operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20  # texts handled at once inside a task
BATCH_BYTES = 4 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"

# Bytes that are no word characters become spaces, A-Z become a-z; bytes above 0x7F stay.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or `name` with underscores added until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def small_batches(df: DataFrame) -> DataFrame:
    """`df`; whole texts reach tasks' Python in batches of about BATCH_BYTES, not 64 MB, where the session sets no size."""
    conf = df.sparkSession.conf
    if conf.get(_BATCHES, None) is None:
        conf.set(_BATCHES, str(BATCH_BYTES))
    return df


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo `modulus`; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % modulus


def byte_slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """First position and values of slices of about SLICE_BYTES; a longer text is a slice of its own."""
    binary = texts.cast(pa.large_binary())
    sizes = np.diff(np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1])
    start = size = 0
    for i, n in enumerate(sizes):
        if i > start and size + n > SLICE_BYTES:
            yield start, binary.slice(start, i - start).to_pylist()
            start, size = i, 0
        size += n
    if start < len(binary):
        yield start, binary.slice(start).to_pylist()


def pieces(text: bytes, size: int = 2 * SLICE_BYTES) -> Iterator[bytes]:
    """The text in pieces of about `size` bytes, cut before ASCII white space."""
    at = 0
    while len(text) - at > size:
        gap = _SPACE.search(text, at + size)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def runs(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner of each element and its place in its run, for runs of the given lengths."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
