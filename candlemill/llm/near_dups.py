"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

Method: a document is a weighted set of shingles of five words. A weight is the shingle's
count times 1 + STRENGTH * log(1 / share) / log(1 / RARE), where share is the share of
documents that hold it, at least RARE. So shingles in less than RARE of the documents
all weigh most, and only the frequent ones, a number that does not grow with the corpus, need
counting: candidates come from Misra-Gries summaries whose total error is
known, and are then counted exactly over all documents.

Improved consistent weighted sampling draws SAMPLES shingles per document so that two documents agree in
each with the probability of their weighted Jaccard similarity. BANDS bands of ROWS
samples make buckets: at similarity 0.8 some band agrees with probability 0.9998.

Buckets are not expanded into pairs. Members are paired with two hubs of their bucket;
each document's most promising pair is verified by exact weighted Jaccard similarity. What is left in buckets of several classes is joined by prefix
filtering, which is exact: in one order of all shingles, the rarest first, similar texts share one of the
first shingles, and what stands before the first shared one bounds their similarity. So texts that share a
long passage and differ in the rest do not meet, as the rest comes first, and no link inside a bucket is lost.
Verification streams texts past a few others that are held, dealt to many tasks: a
document may have any number of partners, and only links leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.session import written

from .common import WORD_BYTES, byte_slices, fresh, runs, small_batches, text_of
from .graph import components

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 4
STRENGTH, RARE = 0.25, 0.005
BROADCAST_IDS = 1_000_000
_DEALT = 256  # tasks the partners of one hub are dealt to at most
_SLOTS = 1 << 20  # counters that put shingles in order of their commonness
_SUMMARY = 1_000_000  # shingles behind one summary
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Word hashes; emptied when it holds 150,000 words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_WORD_HASHES = _Hashes()


def shingle_hashes(texts: list[bytes], size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts one after the other, and their number in each text.

    Fewer than `size` words are one shingle, no words none.
    """
    get = _WORD_HASHES.__getitem__
    hashed = [np.fromiter(map(get, w), np.uint64, len(w)) for w in (t.translate(WORD_BYTES).split() for t in texts)]
    counts = np.fromiter(map(len, hashed), np.int64, len(hashed))
    flat = np.concatenate([np.zeros(0, np.uint64), *hashed])
    del hashed
    number = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    starts = np.cumsum(counts) - counts
    # A shingle of a text with enough words stays inside the text; what stands before the next text is left out.
    rolled = np.zeros(len(flat), np.uint64)
    for i in range(min(size, len(flat))):
        _roll(rolled[: len(flat) - i], flat[i:])
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        single = np.zeros(len(short), np.uint64)
        for i in range(size):  # words beyond the text are zero
            at = np.minimum(starts[short] + i, len(flat) - 1)
            _roll(single, np.where(i < counts[short], flat[at], np.uint64(0)))
        rolled[starts[short]] = single
    owner, place = runs(number)
    place += starts[owner]
    return rolled[place], number


def _roll(rolled: np.ndarray, words: np.ndarray) -> None:
    """Take one more word into each of the hashes, in place."""
    rolled ^= words
    rolled *= _MIX
    rolled ^= rolled >> np.uint64(32)


def distinct_shingles(texts: list[bytes], size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text, their counts, and how many each text has."""
    hashes, number = shingle_hashes(texts, size)
    ends = np.cumsum(number)
    first = np.ones(len(hashes), bool)
    for begin, end in zip((ends - number).tolist(), ends.tolist(), strict=True):
        hashes[begin:end].sort()
    first[1:] = hashes[1:] != hashes[:-1]
    first[(ends - number)[number > 0]] = True
    at = np.flatnonzero(first)
    kept = np.concatenate([[0], np.cumsum(first)])
    return hashes[at], np.diff(np.append(at, len(hashes))), kept[ends] - kept[ends - number]


class Weights:
    """Weights of frequent shingles; all others weigh 1 + STRENGTH."""

    def __init__(self, hashes: np.ndarray, shares: np.ndarray, strength: float = STRENGTH, rare: float = RARE):
        order = np.argsort(hashes)
        self.hashes, self.most = hashes[order], 1 + strength
        self.values = 1 + strength * np.log(1 / np.maximum(shares[order], rare)) / math.log(1 / rare)

    def of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return counts * self.most
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return counts * np.where(self.hashes[at] == hashes, self.values[at], self.most)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, list[bytes]]]:
    for batch in batches:
        for start, some in byte_slices(batch["text"]):
            yield batch, start, some


def frequent_shingles(texts: DataFrame, strength: float = STRENGTH, rare: float = RARE) -> Weights:
    """Weights from exact document counts of all shingles that `rare` of the documents or more hold.

    At most 2 * (mean shingles per document) / rare candidates reach the driver.
    """

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, docs = [], 0
        for _, _, some in _texts(batches):
            waiting.append(distinct_shingles(some)[0])
            docs += len(some)
            if sum(map(len, waiting)) >= _SUMMARY:
                yield _summary(np.concatenate(waiting), docs, rare)
                waiting, docs = [], 0
        if docs:
            yield _summary(np.concatenate(waiting), docs, rare)

    rows = written(texts.mapInArrow(summaries, "hash bigint, n bigint, lost bigint, docs bigint"), "summaries")
    total, lost = rows.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("lost"), F.lit(0))).head()
    counted = rows.where("hash is not null").groupBy("hash").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("n") >= rare * total - lost).select("hash").toArrow()["hash"]
    candidates = np.sort(found.to_numpy().view(np.uint64))
    if not len(candidates):
        return Weights(candidates, np.zeros(0), strength, rare)
    shared = texts.sparkSession.sparkContext.broadcast(candidates)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        counts = np.zeros(len(known), np.int64)
        for _, _, some in _texts(batches):
            hashes = distinct_shingles(some)[0]
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            counts += np.bincount(at[known[at] == hashes], minlength=len(known))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"place": used.astype(np.int64), "n": counts[used]})

    counts = texts.mapInArrow(exact, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    shares = counts["n"].to_numpy() / total
    keep = shares >= rare
    return Weights(candidates[counts["place"].to_numpy()[keep]], shares[keep], strength, rare)


def _summary(hashes: np.ndarray, docs: int, rare: float) -> pa.RecordBatch:
    """Misra-Gries summary: counts less the largest count that does not fit, which is the error."""
    values, counts = np.unique(hashes, return_counts=True)
    room = math.ceil(2 * len(hashes) / (docs * rare)) if len(hashes) else 0
    lost = int(np.partition(counts, len(counts) - room - 1)[len(counts) - room - 1]) if len(counts) > room else 0
    keep = counts > lost
    n = int(keep.sum())
    zeros = np.zeros(n, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*values[keep].view(np.int64).tolist(), None], pa.int64()),
            pa.array([*(counts[keep] - lost).tolist(), 0], pa.int64()),
            pa.array(np.append(zeros, lost)),
            pa.array(np.append(zeros, docs)),
        ],
        ["hash", "n", "lost", "docs"],
    )


_DRAWS = 1 << 16


def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2,1), log of Gamma(2,1) and uniform variates that shingles pick from by their hash."""
    rng = np.random.default_rng(1729)
    r = rng.gamma(2.0, 1.0, _DRAWS).astype(np.float32) + np.float32(1e-6)
    return r, np.log(rng.gamma(2.0, 1.0, _DRAWS)).astype(np.float32), rng.random(_DRAWS, np.float32)


def band_buckets(hashes: np.ndarray, weights: np.ndarray, number: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Bucket of each text (that has shingles) in each band."""
    r_of, c_of, b_of = _draws()
    logs = np.log(weights).astype(np.float32)
    starts = np.cumsum(number) - number
    owner, _ = runs(number)
    odd = np.random.default_rng(271).integers(1 << 62, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.tile(np.arange(bands, dtype=np.uint64), (len(number), 1))
    # Most shingles weigh the same; what they draw is looked up. Others are computed one by one.
    found, times = np.unique(logs, return_counts=True)
    usual = found[np.argmax(times)]
    drawn = c_of - r_of * (np.floor(usual / r_of + b_of) - b_of) - r_of
    others = np.flatnonzero(logs != usual)
    for k in range(bands * rows):
        pick = ((hashes * odd[k]) >> np.uint64(48)).view(np.int64)
        least = drawn.take(pick)
        some = pick[others]
        r, b = r_of[some], b_of[some]
        least[others] = c_of[some] - r * (np.floor(logs[others] / r + b) - b) - r
        lowest = np.flatnonzero(least == np.repeat(np.minimum.reduceat(least, starts), number))
        lowest = lowest[np.unique(owner[lowest], return_index=True)[1]]
        t = np.floor(logs[lowest] / r_of[pick[lowest]] + b_of[pick[lowest]])
        sample = hashes[lowest] ^ (t.astype(np.int64).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        column = out[:, k // rows]
        column ^= sample + np.uint64(k)
        column *= _MIX
        column ^= column >> np.uint64(29)
    return out.view(np.int64)


def _bands(weights, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, start, some in _texts(batches):
            hashes, counts, number = distinct_shingles(some)
            has = number > 0
            made = [[] for _ in some]
            if has.any():
                found = band_buckets(hashes, weights.value.of(hashes, counts), number[has], bands, rows)
                for i, row in zip(np.flatnonzero(has), found, strict=True):
                    made[i] = row
            digests = [xxhash.xxh3_128_digest(t) for t in some]
            yield pa.RecordBatch.from_arrays(
                [batch["id"].slice(start, len(some)), pa.array(digests, pa.binary()), pa.array(made, pa.list_(pa.int64()))],
                ["id", "digest", "buckets"],
            )

    return run


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted sets (hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - both
    return float(both / total) if total > 0 else 0.0


def _verify(weights, least: float):
    """Rows sorted by hub and part, the hub first: keeps (id, hub) of similar texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hubs = None, []
        for batch, start, some in _texts(batches):
            part = batch.slice(start, len(some)).to_pydict()
            hashes, counts, number = distinct_shingles(some)
            values, ends = weights.value.of(hashes, counts), np.cumsum(number)
            good = []
            for i, here in enumerate(zip(part["hub"], part["part"], strict=True)):
                mine = slice(ends[i] - number[i], ends[i])
                own = hashes[mine], values[mine]
                if here != key:
                    key, hubs = here, []
                if part["role"][i] == 0:
                    hubs.append(own)
                elif any(similarity(h, own) >= least for h in hubs):
                    good.append((part["id"][i], part["hub"][i]))
            yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in good], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _checked(pairs: DataFrame, texts: DataFrame, weights, least: float) -> DataFrame:
    """The pairs (id, hub) whose texts are similar enough, as edges (a, b)."""
    dealt = pairs.select("id", "hub", F.pmod(F.xxhash64("id"), F.lit(_DEALT)).cast("int").alias("part"), F.lit(1).alias("role"))
    hubs = dealt.select(F.col("hub").alias("id"), "hub", "part", F.lit(0).alias("role")).distinct()
    rows = dealt.unionByName(hubs).join(texts, "id").repartition("hub", "part").sortWithinPartitions("hub", "part", "role", "id")
    return written(rows.mapInArrow(_verify(weights, least), "a bigint, b bigint"), "links")


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(_SLOTS, np.int64)
    for _, _, some in _texts(batches):
        counts += np.bincount(_slots(distinct_shingles(some)[0]), minlength=_SLOTS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"slot": used.astype(np.int64), "n": counts[used]})


def _slots(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _MIX) >> np.uint64(64 - _SLOTS.bit_length() + 1)).astype(np.int64)


def prefixes(
    hashes: np.ndarray, weights: np.ndarray, number: np.ndarray, commonness: np.ndarray, least: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The shingles by which a text can be found: their places, the weight before each, whether it is held, the texts' sizes.

    Shingles stand in order of commonness, then hash, the same for all texts. If two texts are similar, the larger's
    first shingles, of more than 1 - least of its weight, and the smaller's, of more than
    1 - 2 * least / (1 + least) of its weight (those held), have one in common.
    """
    owner, _ = runs(number)
    order = np.lexsort((hashes, commonness, owner))
    sizes = np.bincount(owner, weights, len(number))
    summed = np.cumsum(weights[order])
    starts = np.cumsum(number) - number
    before = summed - weights[order] - np.concatenate([[0.0], summed])[starts][owner]
    some = 1 + 1e-9
    found = before <= (1 - least) * some * sizes[owner]
    held = before <= (1 - 2 * least / (1 + least)) * some * sizes[owner]
    return order[found], before[found], held[found], sizes


def _prefix_rows(weights, counts, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, start, some in _texts(batches):
            hashes, times, number = distinct_shingles(some)
            common = counts.value[_slots(hashes)]
            places, before, held, sizes = prefixes(hashes, weights.value.of(hashes, times), number, common, least)
            shared = common[places] > 1  # others are in this text alone
            owner = runs(number)[0][places[shared]]
            ids = batch["id"].slice(start, len(some)).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pydict(
                {
                    "hash": hashes[places[shared]].view(np.int64), "id": ids[owner], "size": sizes[owner],
                    "before": before[shared], "held": held[shared],
                }
            )

    return run


def _may_link(a: str, b: str, least: float):
    """Whether two texts that share a shingle of their prefixes can be similar, by what stands before it.

    It is checked at every shared shingle; at the first, all that the texts have in common stands behind.
    """
    part = lambda side, name: F.col(f"{side}.{name}" if side else name)
    behind = F.least(*[part(side, "size") - part(side, "before") for side in (a, b)])
    enough = behind >= (1 - 1e-9) * least / (1 + least) * (part(a, "size") + part(b, "size"))
    smaller_held = F.when(part(a, "size") <= part(b, "size"), part(a, "held")).otherwise(part(b, "held"))
    both = part(a, "held") | part(b, "held")
    return enough & F.when(part(a, "size") == part(b, "size"), both).otherwise(smaller_held)


def _classed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.select(F.col("vertex").alias("id"), "component")
    return rows.join(known, "id", "left").withColumn("class", F.coalesce("component", "id")).drop("component")


def _edges(labels: DataFrame) -> DataFrame:
    """Classes as edges that join the same members, each to the smallest."""
    return labels.select(F.col("vertex").alias("a"), F.col("component").alias("b"))


def _leftover_links(members: DataFrame, labels: DataFrame, texts: DataFrame, weights, least: float) -> DataFrame:
    """Edges (a, b) that join all classes: members to classes known before the last step, and the links found in it.

    Members of a bucket that are still in different classes are compared by prefix filtering.
    First each text meets, per shingle of its prefix, the one that has least weight before that shingle:
    the middle of a group of near copies. Then texts outside a shingle's largest class meet all others they
    can still be similar to.
    """
    spark = texts.sparkSession
    mixed = _classed(members, labels).groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    who = members.join(mixed.where("low <> high"), "bucket", "left_semi").select("id").distinct()
    open_texts = written(texts.join(who, "id", "left_semi"), "open-texts")
    slots = open_texts.mapInArrow(_slot_counts, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(_SLOTS, np.int64)
    counts[slots["slot"].to_numpy()] = slots["n"].to_numpy()
    shared = spark.sparkContext.broadcast(counts.clip(max=(1 << 31) - 1).astype(np.int32))
    kind = "hash bigint, id bigint, size double, before double, held boolean"
    rows = written(open_texts.mapInArrow(_prefix_rows(weights, shared, least), kind), "prefixes")

    classed = _classed(rows, labels)
    middle = F.min(F.struct((F.col("before") / F.col("size")).alias("share"), "id", "class", "size", "before", "held")).alias("hub")
    hubs = classed.groupBy("hash").agg(F.min("class").alias("low"), F.max("class").alias("high"), middle).where("low <> high")
    met = classed.join(hubs.select("hash", "hub"), "hash").where((F.col("class") != F.col("hub.class")) & _may_link("", "hub", least))
    met = written(met.select("id", F.col("hub.id").alias("hub")).distinct(), "middle-pairs")
    found = _checked(met, open_texts, weights, least)
    labels = written(components(_edges(labels).unionByName(found)), "labels")

    classed = written(_classed(rows, labels), "classed")
    sizes = classed.groupBy("hash", "class").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("hash").agg(F.max_by("class", F.struct("n", "class")).alias("largest"), F.count("*").alias("classes"))
    every = written(classed.join(largest.where("classes > 1").drop("classes"), "hash"), "mixed")
    strays, others = every.where("class <> largest").alias("a"), every.alias("b")
    pairs = strays.join(others, F.col("a.hash") == F.col("b.hash")).where((F.col("a.class") != F.col("b.class")) & _may_link("a", "b", least))
    pairs = pairs.select(F.greatest("a.id", "b.id").alias("id"), F.least("a.id", "b.id").alias("hub")).distinct()
    tried = met.select(F.greatest("id", "hub").alias("id"), F.least("id", "hub").alias("hub"))
    rest = _checked(written(pairs.join(tried, ["id", "hub"], "left_anti"), "stray-pairs"), open_texts, weights, least)
    return _edges(labels).unionByName(rest)


def _vertices(rows: DataFrame) -> DataFrame:
    """Adds `vertex`: the id, or for ids that stand before different texts a hash of id and text."""
    texts_of = rows.where("id is not null").groupBy("id").agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
    shared = written(texts_of.where("low <> high").select("id", F.lit(True).alias("shared")), "shared-ids")
    n = shared.count()
    if not n:
        return rows.withColumn("vertex", F.col("id"))
    marked = rows.join(F.broadcast(shared) if n <= BROADCAST_IDS else shared, "id", "left")
    return marked.withColumn("vertex", F.when(F.col("shared"), F.xxhash64("id", "hash")).otherwise(F.col("id"))).drop("shared")


def _labelled(docs: DataFrame, id_col: str, text_col: str, least: float, bands: int, rows: int) -> DataFrame:
    """(id, hash, class_id, kept) of every row; see `classes`."""
    text = text_of(text_col)
    every = small_batches(docs).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    every = _vertices(every)
    named = every.where("id is not null").select(F.col("vertex").alias("id"), "text")
    weights = docs.sparkSession.sparkContext.broadcast(frequent_shingles(named))
    signed = written(named.mapInArrow(_bands(weights, bands, rows), "id bigint, digest binary, buckets array<bigint>"), "signatures")
    copies = written(signed.groupBy("digest").agg(F.min("id").alias("first")), "copies")
    same = signed.select("id", "digest").join(copies, "digest").select(F.col("id").alias("a"), F.col("first").alias("b"))
    same = written(same, "same-text")
    firsts = same.where("a = b").select(F.col("a").alias("id")).distinct()
    members = signed.join(firsts, "id", "left_semi").select("id", F.explode("buckets").alias("bucket")).distinct()

    hubs = members.groupBy("bucket").agg(F.count("*").alias("n"), *[F.min_by("id", F.xxhash64("id", F.lit(s))).alias(f"h{s}") for s in (0, 1)])
    members = written(members.join(hubs.where("n > 1").drop("n"), "bucket"), "shared-buckets")
    met = members.select("id", F.explode(F.array("h0", "h1")).alias("hub")).where("id <> hub")
    pairs = written(met.groupBy("id", "hub").agg(F.count("*").alias("met")), "pairs")
    members = members.select("id", "bucket")
    involved = pairs.select(F.col("id")).union(pairs.select("hub")).distinct()
    if pairs.count() <= BROADCAST_IDS:
        involved = F.broadcast(involved)
    texts = written(named.join(involved, "id", "left_semi").dropDuplicates(["id"]), "texts")
    best = written(pairs.groupBy("id").agg(F.max_by("hub", F.struct("met", "hub")).alias("hub")), "best")
    labels = written(components(_checked(best, texts, weights, least)), "labels")
    joined = components(_leftover_links(members, labels, texts, weights, least).unionByName(same))
    found = every.select("id", "hash", "vertex").join(joined, "vertex", "left").withColumn("class", F.coalesce("component", "vertex"))
    # Of a class the smallest id is kept, which need not be the smallest vertex where ids are shared.
    first = found.where("id is not null").groupBy("class").agg(F.min(F.struct("id", "vertex")).alias("first"))
    found = found.join(first, "class", "left")
    kept = F.coalesce(F.col("vertex") == F.col("first.vertex"), F.lit(True))
    return found.select("id", "hash", F.col("first.id").alias("class_id"), kept.alias("kept"))


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest id of its class), kept.

    Equal texts are one class, texts linked by weighted Jaccard similarity of `least` or more
    too. Texts without words equal only themselves; NULL counts as empty. Ids are whole
    numbers; rows of one id and text are one document, rows of one id and different texts are
    documents of their own, with classes of their own, which may bear the same class_id. Rows of NULL id are
    compared with nothing, have a NULL class and are kept. Of a class the document with the smallest id is
    kept. Empty tables give no rows; other columns are left out.
    """
    found = _labelled(docs, id_col, text_col, least, bands, rows)
    return found.select(F.col("id").alias("doc_id"), "class_id", "kept")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One document of each class, the one with the smallest id; rows of NULL id stay.

    Of rows that repeat id and text one stays; rows that share an id only are judged each by its text.
    """
    name, digest = fresh(docs, "class"), fresh(docs, "digest")
    gone = _labelled(docs, id_col, text_col, least, bands, rows).where(~F.col("kept"))
    gone = gone.select(F.col("id").alias(name), F.col("hash").alias(f"{digest}_")).distinct()
    hashed = docs.withColumn(digest, F.xxhash64(text_of(text_col)))
    mine = (F.col(f"`{id_col}`").cast("bigint") == F.col(name)) & (F.col(digest) == F.col(f"{digest}_"))
    left = hashed.join(gone, mine, "left_anti")
    named = F.col(f"`{id_col}`").isNotNull()
    return left.where(named).dropDuplicates([id_col, digest]).unionByName(left.where(~named)).drop(digest)
