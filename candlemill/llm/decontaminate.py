"""Benchmark decontamination: a broadcast set of benchmark n-grams against the word windows of documents.

Method: the windows of the benchmark are hashed into a sorted array, with the words of
each window beside it. Documents are scanned once in Arrow batches: words become numbers
by a dictionary of the benchmark's words, windows of known words are hashed with rolling
arithmetic, looked up, and every hit is compared word by word before it counts.

A benchmark of up to BLOCK_BYTES of text is broadcast whole, and nothing is shuffled. Of a
larger one tasks hash the windows, and what is broadcast is a set of their hashes of fixed
size (SLOTS bits). Document windows that it may hold, few of all, join the benchmark's
windows by their words; what is found is joined back by digest of the text. The driver then
holds no window of the benchmark.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.session import written

from .common import WORD_BYTES, byte_slices, fresh, runs, text_of

WINDOW = 10
BLOCK_BYTES = 2 << 20
SLOTS = 1 << 27
_SEGMENT = 1 << 15
_SALTS = 8
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes) -> list[bytes]:
    """Maximal runs of digits, letters (A-Z lower-cased) and bytes above 0x7F."""
    return text.translate(WORD_BYTES).split()


class Windows:
    """Windows of one block of benchmark items, ready to be looked up."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                found[n][tuple(ids[i : i + n])].add(item)
        self.by_length = []
        for n, sets in sorted(found.items()):
            keys = np.array(list(sets), np.int64).reshape(-1, n)
            owners = [sorted(x) for x in sets.values()]
            hashes = _rolling(keys.ravel(), n)[::n]
            order = np.argsort(hashes, kind="stable")
            self.by_length.append((n, hashes[order], keys[order], [owners[i] for i in order]))

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
        """Words, hit spans (first word, word after the last) and hit items of each text."""
        get = self.vocabulary.get
        ids = [[get(w, 0) for w in words(t)] for t in texts]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for t in ids for x in t), np.int64, int(counts.sum()))
        owner, place = runs(counts)
        unknown = np.concatenate([[0], np.cumsum(flat == 0)])
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        for n, hashes, keys, owners in self.by_length:
            if len(flat) < n:
                continue
            starts = np.flatnonzero((unknown[n:] == unknown[:-n]) & (counts[owner] - place >= n)[: len(flat) - n + 1])
            if not len(starts):
                continue
            at = np.lib.stride_tricks.sliding_window_view(flat, n)[starts]
            looked = _rolling(at.ravel(), n)[::n]
            first, last = np.searchsorted(hashes, looked, "left"), np.searchsorted(hashes, looked, "right")
            for i in np.flatnonzero(last > first):
                for k in range(first[i], last[i]):
                    if (keys[k] == at[i]).all():
                        doc, begin = owner[starts[i]], int(place[starts[i]])
                        spans[doc].append((begin, begin + n))
                        items[doc].update(owners[k])
        return counts, [_joined(s) for s in spans], items


def _rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n ids."""
    values = ids.astype(np.uint64)
    out = np.zeros(len(values) - n + 1, np.uint64)
    for i in range(n):
        out = out * _MULTIPLIER + values[i : len(values) - n + 1 + i]
        out ^= out >> np.uint64(29)
    return out


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


_SCHEMA = "struct<n_words: bigint, spans: array<struct<first: bigint, after: bigint>>, items: array<string>>"
_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def _scanner(windows: Broadcast):
    """Column function of the texts."""

    @F.arrow_udf(_SCHEMA)
    def scan(text: pa.Array) -> pa.Array:
        parts = []
        for _, some in byte_slices(text):
            rows = [
                {"n_words": int(n), "spans": [{"first": a, "after": b} for a, b in s], "items": sorted(i)}
                for n, s, i in zip(*windows.value.scan(some), strict=True)
            ]
            parts.append(pa.array(rows, _ARROW))
        return pa.concat_arrays(parts) if parts else pa.array([], _ARROW)

    return scan.asNondeterministic()


def _word_hashes(texts: list[list[bytes]]) -> list[np.ndarray]:
    known: dict[bytes, int] = {}
    for text in texts:
        for word in text:
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
    return [np.fromiter(map(known.__getitem__, text), np.uint64, len(text)) for text in texts]


def _benchmark_windows(texts: DataFrame, window: int) -> DataFrame:
    """Distinct (item, n, hash, words) of the windows of benchmark rows (item, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch["item"].to_pylist()
            for start, some in byte_slices(batch["text"]):
                split = [words(t) for t in some]
                for i, (found, hashes) in enumerate(zip(split, _word_hashes(split), strict=True)):
                    n = min(window, len(found))
                    if n:
                        yield pa.RecordBatch.from_pydict(
                            {
                                "item": [items[start + i]] * (len(found) - n + 1),
                                "n": pa.array([n] * (len(found) - n + 1), pa.int32()),
                                "hash": _rolling(hashes, n).view(np.int64),
                                "words": pa.array([b" ".join(found[k : k + n]) for k in range(len(found) - n + 1)], pa.binary()),
                            }
                        )

    return texts.mapInArrow(run, "item string, n int, hash bigint, words binary").distinct()


def _hash_set(windows: DataFrame) -> np.ndarray:
    """SLOTS bits, those of the windows' hashes set; packed by segment in tasks."""

    def pack(key, rows):
        bits = np.zeros(_SEGMENT, np.uint8)
        bits[rows["slot"].to_numpy() % _SEGMENT] = 1
        return pa.table({"segment": key[0:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    slots = windows.select(F.col("hash").bitwiseAND(SLOTS - 1).alias("slot")).distinct()
    segments = slots.groupBy(F.floor(F.col("slot") / _SEGMENT).alias("segment")).applyInArrow(pack, "segment bigint, bits binary")
    packed = np.zeros((SLOTS // _SEGMENT, _SEGMENT // 8), np.uint8)
    found = segments.toArrow()  # SLOTS / 8 bytes at most
    for segment, bits in zip(found["segment"].to_pylist(), found["bits"].to_pylist(), strict=True):
        packed[segment] = np.frombuffer(bits, np.uint8)
    return packed.ravel()


def _maybe_windows(texts: DataFrame, bits: Broadcast, lengths: list[int]) -> DataFrame:
    """Distinct (digest, first, n, words) of the texts' windows whose hash the set holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, some in byte_slices(batch["text"]):
                split = [words(t) for t in some]
                for text, found, hashes in zip(some, split, _word_hashes(split), strict=True):
                    for n in lengths:
                        if len(found) < n:
                            continue
                        slots = _rolling(hashes, n) & np.uint64(SLOTS - 1)
                        at = bits.value[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1
                        first = np.flatnonzero(at)
                        if len(first):
                            yield pa.RecordBatch.from_pydict(
                                {
                                    "digest": pa.array([hashlib.sha256(text).digest()] * len(first), pa.binary()),
                                    "first": first.astype(np.int64),
                                    "n": np.full(len(first), n, np.int32),
                                    "words": pa.array([b" ".join(found[k : k + n]) for k in first], pa.binary()),
                                }
                            )

    return texts.mapInArrow(run, "digest binary, first bigint, n int, words binary").distinct()


def _join_spans(spans: pa.Array) -> pa.Array:
    joined = [_joined([(s["first"], s["after"]) for s in row]) for row in spans.to_pylist()]
    return pa.array([[{"first": a, "after": b} for a, b in row] for row in joined], _ARROW.field("spans").type)


def _count_words(text: pa.Array) -> pa.Array:
    return pa.array([len(words(t)) for _, some in byte_slices(text) for t in some], pa.int64())


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))


def _by_shuffle(docs: DataFrame, texts: DataFrame, out: str, text_col: str, window: int) -> DataFrame:
    """`find_leaks` for a benchmark (item, text) of any size; a window or text that very many rows share is dealt over salts."""
    windows = written(_benchmark_windows(texts, window), "windows")
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # `window` numbers at most
    bits = docs.sparkSession.sparkContext.broadcast(_hash_set(windows))
    hits = written(_maybe_windows(docs.select(text_of(text_col).alias("text")), bits, lengths), "hits")
    bits.unpersist()
    hits = hits.withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(_SALTS)).cast("int"))
    occurring = windows.select("words", "item").join(hits.select("words").distinct(), "words", "left_semi")
    verified = hits.join(_salted(occurring.select("words").distinct()), ["words", "salt"], "left_semi")
    spans = verified.groupBy("digest").agg(F.collect_list(F.struct("first", (F.col("first") + F.col("n")).alias("after"))).alias("spans"))
    owners = hits.select("digest", "words", "salt").distinct().join(_salted(occurring), ["words", "salt"])
    items = owners.groupBy("digest").agg(F.sort_array(F.collect_set("item")).alias("items"))
    join_spans = F.arrow_udf(_join_spans, "array<struct<first: bigint, after: bigint>>")
    leaks = written(spans.select("digest", join_spans("spans").alias("spans")).join(items, "digest"), "leaks")

    digest, salt, found = (fresh(docs, f"{out}_{x}") for x in ("digest", "salt", "found"))
    right = _salted(leaks).select(F.col("digest").alias(digest), F.col("salt").alias(salt), F.struct("spans", "items").alias(found))
    keyed = docs.withColumn(digest, F.unhex(F.sha2(text_of(text_col), 256))).withColumn(salt, F.spark_partition_id() % _SALTS)
    joined = keyed.join(right, [digest, salt], "left")
    none = F.from_json(F.lit('{"spans": [], "items": []}'), "struct<spans: array<struct<first: bigint, after: bigint>>, items: array<string>>")
    held = F.coalesce(F.col(f"`{found}`"), none)
    leak = F.struct(F.arrow_udf(_count_words, "bigint")(text_of(text_col)).alias("n_words"), held["spans"].alias("spans"), held["items"].alias("items"))
    return joined.select(*[f"`{c}`" for c in docs.columns if c.lower() != out.lower()], leak.alias(out))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    out: str = "leak",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Add struct column `out`: n_words, spans of hit words (first, after) and the hit items as text.

    A word is hit if it lies in any occurrence of a window of `window` consecutive
    words of an item; an item of fewer words is one window, one without words none.
    NULL texts have no words; items with NULL id count under the text `null`. Repeated
    rows are scanned like others; empty tables give empty spans. If `docs` has a
    column called `out`, that column is replaced.
    """
    texts = benchmark.select(
        F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null")).alias("item"),
        text_of(item_text_col).alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text") + 16)).head()[0] or 0
    if size > BLOCK_BYTES:
        return _by_shuffle(docs, texts, out, text_col, window)
    windows = Windows([(r["item"], r["text"].encode()) for r in texts.collect()], window)
    found = _scanner(docs.sparkSession.sparkContext.broadcast(windows))(text_of(text_col))
    return docs.select(*[f"`{c}`" for c in docs.columns if c.lower() != out.lower()], found.alias(out))


def hit_words(leak: str = "leak") -> Column:
    """Hit words of a leak column."""
    return F.aggregate(F.col(leak)["spans"], F.lit(0).cast("bigint"), lambda n, s: n + s["after"] - s["first"])


def remove_leaks(docs: DataFrame, benchmark: DataFrame, spans_only: bool = False, text_col: str = "text", **options) -> DataFrame:
    """Documents without benchmark text, with their own columns only.

    Documents with a hit go; with `spans_only` they stay, and each hit span, from its
    first word to its last, is cut out of the text. Clean rows are unchanged, NULL texts too.
    """
    leak = fresh(docs, "leak")
    found = find_leaks(docs, benchmark, leak, text_col=text_col, **options)
    if not spans_only:
        return found.where(F.size(F.col(leak)["spans"]) == 0).drop(leak)

    @F.arrow_udf("string")
    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([_cut(t, s) if s else t for t, s in zip(text.to_pylist(), spans.to_pylist(), strict=True)], pa.string())

    return found.withColumn(text_col, cut(F.col(f"`{text_col}`"), F.col(leak)["spans"])).select(*[f"`{c}`" for c in docs.columns])


def _cut(text: str, spans: list[dict]) -> str:
    data = text.encode()
    mask = np.frombuffer(data.translate(WORD_BYTES), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for s in spans:
        out.append(data[at : begins[s["first"]]])
        at = ends[s["after"] - 1]
    out.append(data[at:])
    return b"".join(out).decode()


def report(found: DataFrame, id_col: str = "doc_id", leak: str = "leak") -> DataFrame:
    """One row per document: counts, digest of the hit items, verdict."""
    items = F.col(leak)["items"]
    return found.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(leak)["n_words"].alias("n_words"),
        hit_words(leak).alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size(F.col(leak)["spans"]) > 0).alias("contaminated"),
    )


def digest(items: list[str]) -> str:
    """The items digest of `report`, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
