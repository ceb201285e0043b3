"""License scans with DataFrame expressions only: MinHash bands over overlapping windows.

Method: templates are grouped by their number of shingles m. A text's shingles are cut
into blocks of m; a window is two neighbouring blocks, so every run of m shingles lies whole
in a window. A window that holds a share c of a template has a Jaccard similarity of
at least c / (3 - c) with it. One-row bands, each the minimum of the shingle hashes under
another mask, collide with that probability each; there are as many bands as bring the
probability that none collides below MISS. Templates that collide are verified by exact
containment of shingles.

Shingles have five words, or all words of a shorter template. Windows are made only of texts
that hold, anywhere, as many shingles of a group of templates as containment asks for.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_of
from .license_templates import common_templates

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
MISS = 1e-5
MAX_TEMPLATE_SHINGLES = 100_000  # of all templates; they travel inside the plan

# The usual short notices, and the headers, SPDX lines and texts of common licences.
TEMPLATES = common_templates() | {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files, to deal in the software without restriction",
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, letters (A-Z lower-cased) and other characters above 0x7F."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _BETWEEN), lambda w: w != "")


def shingles(words: Column, size: int) -> Column:
    """Hashes of all runs of `size` words."""
    last = F.size(words) - size + 1
    made = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(size)]))
    return F.when(last >= 1, made).otherwise(F.array().cast("array<bigint>"))


def bands_needed(containment: float, miss: float = MISS) -> int:
    similarity = containment / (3 - containment)
    return math.ceil(math.log(miss) / math.log(1 - similarity))


def masks(n: int) -> list[int]:
    """n masks that differ in their highest bits."""
    bits = max(1, math.ceil(math.log2(n)))
    low = np.random.default_rng(41).integers(0, 1 << (64 - bits), n, np.uint64)
    high = np.arange(n, dtype=np.uint64) << np.uint64(64 - bits)
    return (high | low).view(np.int64).tolist()


def _minima(hashes: Column, bands: int) -> list[Column]:
    def lowest(mask: int) -> Column:
        return F.array_min(F.transform(hashes, lambda x: x.bitwiseXOR(F.lit(mask))))

    return [lowest(m) for m in masks(bands)]


def _windows(hashes: str, length: int, number: int) -> Column:
    """Two neighbouring blocks each, with the number of the class and the first word of the first block."""
    blocks = F.ceil(F.size(hashes) / length).cast("int")
    made = F.transform(
        F.sequence(F.lit(0), F.greatest(blocks, F.lit(1)) - 1),
        lambda q: F.struct(
            F.lit(number).alias("class"),
            (q * length).alias("first_word"),
            F.slice(hashes, q * length + 1, F.lit(2 * length)).alias("hashes"),
        ),
    )
    return F.filter(made, lambda w: F.size(w["hashes"]) > 0)


def _once(value: Column) -> Column:
    """The value through a generator, below which no later filter or projection is copied."""
    return F.explode(F.array(value))


@dataclass
class _Class:
    """Templates of one shingle size and number of shingles."""

    size: int
    length: int
    names: list[str]
    hashes: list[list[int]]
    minima: list[list[int]]  # by template and band


def _classes(spark: SparkSession, templates: dict[str, str], bands: int) -> list[_Class]:
    rows = spark.createDataFrame(sorted(templates.items()), "name string, text string")
    rows = rows.select("name", _once(words(text_of("text"))).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(SHINGLE_WORDS))
    by_size = F.array(*[F.array_distinct(shingles(F.col("words"), n)) for n in range(1, SHINGLE_WORDS + 1)])
    made = rows.select("name", size.alias("size"), _once(F.element_at(by_size, size)).alias("hashes"))
    out: dict[tuple[int, int], _Class] = {}
    for r in made.withColumn("minima", F.array(*_minima(F.col("hashes"), bands))).collect():
        c = out.setdefault((r["size"], len(r["hashes"])), _Class(r["size"], len(r["hashes"]), [], [], []))
        c.names.append(r["name"])
        c.hashes.append(r["hashes"])
        c.minima.append(r["minima"])
    return list(out.values())


def _longs(values: list[int]) -> Column:
    """A constant array; one literal, as there are many values."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _member(hashes: set[int]):
    """Is a hash one of these? Tables of slots, each for what the one before had no place for."""
    levels, left, shift = [], sorted(hashes), 0
    while left and shift + (bits := max(4, (8 * len(left)).bit_length())) < 64:
        slots, rest = [0] * (1 << bits), []
        for h in left:
            at = (h >> shift) & ((1 << bits) - 1)
            if slots[at]:
                rest.append(h)
            else:
                slots[at] = h
        levels.append((shift, (1 << bits) - 1, _longs(slots)))
        left, shift = rest, shift + bits
    if left:
        levels.append((0, 0, None))

    def test(x: Column) -> Column:
        found = F.lit(False)
        for shift, mask, slots in levels:
            if slots is None:
                found = found | F.array_contains(_longs(left), x)
            else:
                found = found | (F.element_at(slots, F.shiftright(x, shift).bitwiseAND(F.lit(mask)).cast("int") + 1) == x)
        return found

    return test


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    containment: float = CONTAINMENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document and template found: doc_id, license, n_windows that hold it,
    first_word of the first of them (from 0), containment (the best).

    NULL and empty texts hold nothing, nor do templates without words. Rows of one id are
    taken together, NULL being an id of its own; repeated rows count their windows each.
    Empty tables give no rows; other columns are left out.
    """
    templates = TEMPLATES if templates is None else templates
    bands = bands_needed(containment)
    classes = _classes(docs.sparkSession, templates, bands)
    if sum(len(h) for c in classes for h in c.hashes) > MAX_TEMPLATE_SHINGLES:
        raise ValueError("too many template shingles for one scan; scan in blocks of templates")
    if not classes:
        classes = [_Class(1, 1, [""], [[0]], [[0] * bands])]  # a template that no text holds
    sizes = sorted({c.size for c in classes})
    made = docs.select(F.col(f"`{id_col}`").alias("doc_id"), _once(words(text_of(text_col))).alias("words"))
    every = F.struct(*[shingles(F.col("words"), n).alias(f"s{n}") for n in sizes])
    made = made.select("doc_id", _once(every).alias("s")).select("doc_id", "s.*")
    members = {n: {h for c in classes if c.size == n for t in c.hashes for h in t} for n in sizes}
    held = F.struct(*[F.array_distinct(F.filter(f"s{n}", _member(members[n]))).alias(f"h{n}") for n in sizes])
    made = made.select("*", _once(held).alias("h")).select("*", "h.*")
    some = F.lit(False)
    for n in sizes:
        some = some | (F.size(f"h{n}") > 0)
    made = made.where(some)
    none = F.array().cast("array<struct<class:int,first_word:int,hashes:array<bigint>>>")
    enough = [
        F.size(F.array_intersect(f"h{c.size}", _longs(sorted({h for t in c.hashes for h in t})))) >= F.lit(containment * c.length - 1e-6)
        for c in classes
    ]
    cut = F.concat(*[F.when(e, _windows(f"s{c.size}", c.length, i)).otherwise(none) for i, (c, e) in enumerate(zip(classes, enough, strict=True))])
    rows = made.select("doc_id", F.explode(cut).alias("w")).select("doc_id", "w.*")
    rows = rows.select("*", _once(F.array(*_minima(F.col("hashes"), bands))).alias("minima"))
    known = [(i, c.names[k], c.hashes[k], c.minima[k]) for i, c in enumerate(classes) for k in range(len(c.names))]
    collided = [F.when((F.col("class") == i) & _agree(m), F.lit(k + 1)) for k, (i, _, _, m) in enumerate(known)]
    found = rows.select("doc_id", "first_word", "hashes", F.explode(F.array_compact(F.array(*collided))).alias("t"))
    template = F.element_at(F.array(*[_longs(h) for _, _, h, _ in known]), F.col("t"))
    windows = found.select(
        "doc_id",
        F.element_at(F.array(*[F.lit(n) for _, n, _, _ in known]), F.col("t")).alias("license"),
        "first_word",
        (F.size(F.array_intersect("hashes", template)) / F.size(template)).alias("containment"),
    )
    return (
        windows.where(F.col("containment") >= containment)
        .groupBy("doc_id", "license")
        .agg(
            F.count("*").alias("n_windows"),
            F.min("first_word").cast("bigint").alias("first_word"),
            F.max("containment").alias("containment"),
        )
    )


def _agree(values: list[int]) -> Column:
    """Is any band minimum that of the template?"""
    return F.exists(F.zip_with("minima", _longs(values), lambda a, b: a == b), lambda same: same)
