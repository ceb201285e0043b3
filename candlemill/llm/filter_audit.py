"""How five document filters interact, in every order, per part of the corpus.

Method: every document becomes five bits, one per filter it fails. Documents are counted per
part and combination of bits, which gives each part a tensor of 2x2x2x2x2 counts, one for
all documents, one for the good and one for the toxic ones. Each step of each order of the
filters is a contraction of that tensor: along an axis, `pass` selects what passed the
filter, `fail` what failed it, `all` sums both. No order is ever run over documents.

Only the bits leave the scan of the texts. A text is known by a digest; copies are counted
per digest and part before they meet, so a text with very many copies arrives as few rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_slices, pieces, text_of

FILTERS = "ABCDE"
LEAST_WORDS = 50  # A: fewer words fail
DISTINCT_PERCENT = 65  # B: a smaller share of distinct words fails
UPPER_PERCENT = 5  # C: a larger share of A-Z fails
SYMBOLS = b"#$%&*|"  # D: any of these fails
COPY = 1 << FILTERS.index("E")

_NOT_UPPER = bytes(b for b in range(256) if not 0x41 <= b <= 0x5A)
_CONTINUED = bytes(range(0x80, 0xC0))

ROWS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def word_counts(text: bytes) -> tuple[int, int]:
    """Words and distinct words between ASCII white space; long texts piece by piece."""
    seen, total = set(), 0
    for piece in pieces(text):
        words = piece.split()
        total += len(words)
        seen.update(words)
    return total, len(seen)


def failed(text: bytes) -> int:
    """Bits of the filters A to D that a text fails; the empty text fails A alone."""
    words, distinct = word_counts(text)
    upper = len(text.translate(None, _NOT_UPPER))
    points = len(text.translate(None, _CONTINUED))
    return (
        (words < LEAST_WORDS)
        | (100 * distinct < DISTINCT_PERCENT * words) << 1
        | (100 * upper > UPPER_PERCENT * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, some in byte_slices(batch["text"]):
            rows = [batch[c].slice(start, len(some)) for c in ("id", "part")]
            digests = pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in some], pa.binary())
            bits = pa.array([failed(t) for t in some], pa.int32())
            yield pa.RecordBatch.from_arrays([*rows, digests, bits], ["id", "part", "digest", "bits"])


def _flagged(column: str) -> Column:
    return F.max(F.coalesce(F.col(f"`{column}`").cast("int") == 1, F.lit(False)))


def outcomes(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """Documents per (part, bits): n, good, toxic. Bits are those of the filters failed.

    NULL parts count as '', NULL texts as empty. A document fails E if a smaller id has the
    same text anywhere; rows of NULL id are never copies and never labelled. Rows that repeat
    count each; of several labels of an id the larger counts.
    """
    name = f"`{id_col}`"
    known = labels.where(F.col(name).isNotNull()).groupBy(F.col(name).cast("bigint").alias("id"), F.lit(0).alias("salt"))
    known = known.agg(_flagged("quality").alias("good"), _flagged("toxic").alias("toxic"))
    rows = docs.select(
        F.col(name).cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        text_of(text_col).alias("text"),
    ).mapInArrow(_scan, "id bigint, part string, digest binary, bits int")
    # Rows without id meet no label; the salt keeps them from meeting in one task.
    salted = rows.withColumn("salt", F.when(F.col("id").isNull(), F.xxhash64("digest", "part")).otherwise(F.lit(0)))
    marked = salted.join(known.withColumn("salt", F.col("salt").cast("bigint")), ["id", "salt"], "left")
    marked = marked.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    kind = ["part", "digest", "bits", "good", "toxic"]
    each = marked.groupBy("id", "salt", *kind).agg(F.count("*").alias("n"))
    named = F.col("id").isNotNull()
    copies = each.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(named, F.col("n"))), F.lit(0)).alias("named"),
        F.min(F.when(named, F.struct("id", "n"))).alias("first"),
    )
    lowest = F.min("first.id").over(Window.partitionBy("digest"))
    original = F.when(F.col("first.id") == F.col("lowest"), F.col("first.n")).otherwise(F.lit(0))
    split = copies.withColumn("lowest", lowest).withColumn("copied", F.col("named") - original)
    found = split.groupBy("part", "bits", "good", "toxic").agg(F.sum(F.col("n") - F.col("copied")).alias("n"), F.sum("copied").alias("copied"))
    both = F.array(F.struct("bits", "n"), F.struct((F.col("bits") + COPY).alias("bits"), F.col("copied").alias("n")))
    cells = found.select("part", "good", "toxic", F.explode(both).alias("cell")).select("part", "good", "toxic", "cell.*")
    return cells.groupBy("part", "bits").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(F.lit(0))).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(F.lit(0))).alias("toxic"),
    )


_PASS, _FAIL, _ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])


def contract(counts: np.ndarray, axes: list[np.ndarray]) -> np.ndarray:
    """Sums of counts (parts, 2, 2, 2, 2, 2, kinds) of what is selected along each filter's axis."""
    return np.einsum("pabcdek,a,b,c,d,e->pk", counts, *axes)


def orders(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Columns of the audit, (parts, orders, steps) each, from counts (parts, 32, kinds n, good, toxic).

    Bit i of the second axis says that filter i fails.
    """
    size = len(FILTERS)
    # Row-major reshaping makes the first axis the highest bit; turn it round.
    tensor = counts.reshape(len(counts), *[2] * size, 3).transpose(0, *range(size, 0, -1), size + 1)
    everyone, steps = set(range(size)), {}
    for f in range(size):
        others = sorted(everyone - {f})
        failing = contract(tensor, [_FAIL if i == f else _ALL for i in range(size)])[:, 0]
        alone = contract(tensor, [_FAIL if i == f else _PASS for i in range(size)])[:, 0]
        for k in range(size):
            for before in itertools.combinations(others, k):
                earlier = [_PASS if i in before else _ALL for i in range(size)]
                gone = contract(tensor, [_FAIL if i == f else earlier[i] for i in range(size)])
                kept = contract(tensor, [_PASS if i == f else earlier[i] for i in range(size)])[:, 0]
                steps[f, before] = {
                    "kept": kept, "removed": gone[:, 0], "redundant": failing - gone[:, 0], "unique_fails": alone,
                    "good_lost": gone[:, 1], "toxic_lost": gone[:, 2],
                }
    total = {
        f: sum(
            math.factorial(len(before)) * math.factorial(size - 1 - len(before)) * values["removed"]
            for (g, before), values in steps.items()
            if g == f
        )
        for f in everyone
    }
    every = [(order[k], tuple(sorted(order[:k]))) for order in itertools.permutations(range(size)) for k in range(size)]
    shape = (len(counts), math.factorial(size), size)
    columns = {c: np.stack([steps[key][c] for key in every], axis=1).reshape(shape) for c in steps[0, ()]}
    return columns | {"shapley": np.stack([total[f] for f, _ in every], axis=1).reshape(shape)}


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["".join(order) for order in itertools.permutations(FILTERS)]
    size = len(FILTERS)
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            rows = batch.slice(start, 64).to_pydict()
            counts = np.zeros((len(rows["part"]), 1 << size, 3), np.int64)
            for i, cells in enumerate(rows["cells"]):
                for cell in cells:
                    counts[i, cell["bits"]] = cell["n"], cell["good"], cell["toxic"]
            found = orders(counts)
            per_part = len(names) * size
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.repeat(np.array(rows["part"], object), per_part), pa.string()),
                    "filter_order": pa.array(np.tile(np.repeat(names, size), len(counts)), pa.string()),
                    "step": np.tile(np.arange(1, size + 1, dtype=np.int32), len(counts) * len(names)),
                }
                | {c: found[c].ravel() for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")}
            )


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part, order of the filters and step; columns as in `ROWS`, see `outcomes` for awkward rows.

    kept, removed: documents left after and taken by the step; redundant: those that fail its
    filter and are gone already; unique_fails: those that fail no other; good_lost,
    toxic_lost: of those removed; shapley: removed by this filter, summed over all orders.
    An empty table gives no rows; further columns of the documents are not read.
    """
    cells = outcomes(docs, labels, **columns).groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("cells"))
    return cells.mapInArrow(_audited, ROWS)
