r"""Language-model scores from a probabilistic suffix tree.

Method: the symbols are the bytes of a text, written as its words with one space after
each, and a line break as its end. Contexts of up to DEPTH symbols that come at least at
a share of LEAST_SHARE of all positions are candidates; one is retained if its next-symbol
distribution diverges from its parent's (the context without its oldest symbol) by at
least DIVERGENCE nats. Distributions are smoothed by the parent's. Retained contexts and
their prefixes are the states of an automaton, whose state is always the longest retained
suffix; at most DEPTH / LEAST_SHARE of them, so the tree can be broadcast.

That tree spells words out. It is mixed in equal parts with the words' shares in the whole
corpus, the root of a second tree whose symbols are words and whose contexts are up to
CONTEXT_WORDS words before. A context is retained if training holds it LEAST_SEEN times, a number
and not a share, so this tree grows with the corpus; its distributions are smoothed by the parent's too.
It is never in one place: runs of words of a chunk of documents are counted there, summed by
hash bucket and their sums sent back to the chunk.
A word that training does not know is one event, the unknown word; its probability at the root is
the share of words seen once (Good-Turing), and the known words share the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.session import written

from .common import byte_slices, remainder, runs, text_of

DEPTH = 5
LEAST_SHARE = 5e-5
SEEN_SHARE = 1e-6  # rarer followers of a context are left to the parent's distribution
DIVERGENCE = 0.02
PRIOR = 4.0
MIXED = 0.5
CONTEXT_WORDS = 2
LEAST_SEEN = 2
WORD_PRIOR = 64.0
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
FEWEST = 64
_RUN_BITS = 40  # of a run of several words, besides its bucket; words keep all 64
_LANE = 512
_COUNTED = 1 << 20  # symbols counted at once
_MOST_GRAMS = 1_000_000  # distinct ones a task gathers before it sends them
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b or 1 for b in range(256))  # NUL counts as byte 1
_END = b"\n"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


def stream(words: list[bytes]) -> bytes:
    """The symbols of a text."""
    return b" ".join([*words, _END])


def longest_grams(data: bytes, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of depth + 1 symbols (as numbers) and their counts.

    `data` is any number of texts' symbols; a run does not reach back beyond the line
    break before its text, and has zeros there.
    """
    symbols = np.frombuffer(_END + data, np.uint8).astype(np.uint64)
    at = np.arange(len(symbols))
    opened = np.maximum.accumulate(np.where(np.append(True, symbols[:-1] == 0x0A), at, 0))  # first symbol of the text
    back = at - np.maximum(opened - 1, 0)  # symbols before, the line break among them
    keys = np.zeros(len(symbols) - 1, np.uint64)
    for k in range(depth, -1, -1):
        shifted = np.zeros(len(symbols), np.uint64)
        shifted[k:] = symbols[: max(0, len(symbols) - k)]
        keys = (keys << np.uint64(8)) | np.where(back >= k, shifted, 0)[1:]
    return np.unique(keys, return_counts=True)


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    values, counts = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.argsort(values, kind="stable")  # two sorted runs are merged in linear time
    values = values[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts[order], first).astype(np.int64) if len(first) else np.zeros(0, np.int64)


def all_grams(values: np.ndarray, counts: np.ndarray, depth: int = DEPTH) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length 1 to depth + 1: distinct runs and their counts, from the longest ones."""
    out = []
    for length in range(depth + 1, 0, -1):
        values = values & np.uint64((1 << (8 * length)) - 1)
        kept, place = np.unique(values, return_inverse=True)
        summed = np.bincount(place, counts).astype(np.int64)
        whole = kept >> np.uint64(8 * (length - 1)) > 0
        out.append((kept[whole], summed[whole]))
        values, counts = kept, summed
    return out[::-1]


@dataclass
class Tree:
    """Automaton over states: where each symbol leads (times 256), and its log10 probability."""

    moves: np.ndarray
    logs: np.ndarray
    start: int
    contexts: dict[bytes, int]

    def log10_of(self, data: bytes) -> np.ndarray:
        """log10 probability of each symbol; `data` is any number of texts' symbols."""
        if not data:
            return np.zeros(0)
        lanes = -(-len(data) // _LANE)
        padded = np.frombuffer(b"\n" * DEPTH + data + b"\n" * (lanes * _LANE - len(data)), np.uint8)
        # Each lane begins DEPTH symbols early, from which on its state is exact.
        cut = np.lib.stride_tricks.sliding_window_view(padded, _LANE + DEPTH)[::_LANE].T.astype(np.int32, order="C")
        state = np.full(lanes, self.start * 256, np.int32)
        out = np.empty((_LANE, lanes), np.float32)
        for t in range(_LANE + DEPTH):
            at = state + cut[t]
            if t >= DEPTH:
                out[t - DEPTH] = self.logs[at]
            state = self.moves[at]
        return out.T.ravel()[: len(data)].astype(np.float64)


def build(grams: list[tuple[np.ndarray, np.ndarray]], least_share: float = LEAST_SHARE, divergence: float = DIVERGENCE) -> Tree:
    """The tree of the corpus's gram counts, by length."""
    singles = np.zeros(256)
    singles[grams[0][0].astype(int)] = grams[0][1]
    total = singles.sum()
    nodes: dict[bytes, np.ndarray] = {b"": (singles + 1) / (total + 256)}
    retained: set[bytes] = set()
    for length in range(1, len(grams)):
        keys, counts = grams[length - 1]
        keep = counts >= max(2, least_share * total)
        contexts, seen = keys[keep], counts[keep]
        followers, n = grams[length]
        order = np.argsort(followers, kind="stable")
        followers, n = followers[order], n[order]
        first = np.searchsorted(followers, contexts << np.uint64(8))
        last = np.searchsorted(followers, (contexts << np.uint64(8)) | np.uint64(255), "right")
        for context, count, i, j in zip(contexts, seen, first, last, strict=True):
            name = int(context).to_bytes(length, "big")
            parent = nodes[name[1:]]
            row = np.zeros(256)
            row[(followers[i:j] & np.uint64(255)).astype(int)] = n[i:j]
            rest = max(float(count) - row.sum(), 0.0) + PRIOR  # rare followers and the prior go by the parent
            own = (row + rest * parent) / (row.sum() + rest)
            nodes[name] = own
            if (own * np.log(own / parent)).sum() >= divergence:
                retained.add(name)
    retained |= {c[i:] for c in retained for i in range(1, len(c))}
    states = sorted({b"", _END} | {c[:i] for c in retained for i in range(1, len(c) + 1)}, key=lambda c: (len(c), c))
    number = {c: i for i, c in enumerate(states)}
    logs, longest = np.zeros((len(states), 256), np.float32), {b"": b""}
    for context in states:  # shorter ones come first
        if context:
            longest[context] = context if context in retained else longest[_shorter(context, number)]
        logs[number[context]] = np.log10(nodes[longest[context]])
    moves = _completed(states, number)
    return Tree((moves * 256).astype(np.int32).ravel(), logs.ravel(), number[_END], number)


def _shorter(context: bytes, known: dict[bytes, int]) -> bytes:
    """The longest known proper suffix."""
    context = context[1:]
    while context not in known:
        context = context[1:]
    return context


def _completed(states: list[bytes], number: dict[bytes, int]) -> np.ndarray:
    """Where each symbol leads: to the longest suffix that is a state; a line break to the start of a text."""
    moves = np.zeros((len(states), 256), np.int64)
    children: dict[bytes, list[tuple[int, int]]] = {}
    for c in states[1:]:
        children.setdefault(c[:-1], []).append((c[-1], number[c]))
    for c in states:
        i = number[c]
        if c:
            moves[i] = moves[number[_shorter(c, number)]]
        for symbol, child in children.get(c, []):
            moves[i, symbol] = child
    moves[:, 0x0A] = number[_END]
    return moves


def learn_tree(texts: DataFrame) -> Tree:
    """The tree of all rows (text) of a corpus."""

    def count(batches):
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting, size, found = [], 0, none
        for batch in batches:
            for _, some in byte_slices(batch["text"]):
                for text in some:
                    waiting.append(stream(tokens(text)))
                    size += len(text)
                    if size >= _COUNTED:
                        found = merged(found, longest_grams(b"".join(waiting)))
                        waiting, size = [], 0
                if len(found[0]) > _MOST_GRAMS:
                    yield _grams(*found)
                    found = none
        yield _grams(*merged(found, longest_grams(b"".join(waiting))))

    counted = texts.mapInArrow(count, "length int, gram bigint, n bigint").groupBy("length", "gram").agg(F.sum("n").alias("n"))
    counted = written(counted, "grams")
    total = counted.where("length = 1").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    rows = counted.where(F.col("n") >= SEEN_SHARE * total).toArrow()
    length, gram, n = (rows[c].to_numpy() for c in ("length", "gram", "n"))
    grams = []
    for k in range(1, DEPTH + 2):
        at = np.flatnonzero(length == k)
        at = at[np.argsort(gram[at])]
        grams.append((gram[at].astype(np.uint64), n[at]))
    return build(grams)


def _grams(values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    made = all_grams(values, counts)
    return pa.RecordBatch.from_pydict(
        {
            "length": np.repeat(np.arange(1, len(made) + 1, dtype=np.int32), [len(k) for k, _ in made]),
            "gram": np.concatenate([k for k, _ in made]).astype(np.int64),
            "n": np.concatenate([n for _, n in made]),
        }
    )


@dataclass
class _Words:
    """The symbols of some texts, where words end in them, the words' numbers, each text's number of words, the distinct words' hashes."""

    data: bytes
    ends: np.ndarray
    numbers: np.ndarray
    counts: np.ndarray
    hashes: np.ndarray


def _words(texts: pa.ChunkedArray) -> _Words:
    data = b"".join([stream(tokens(t)) for t in texts.cast(pa.large_binary()).to_pylist()])
    symbols = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero((symbols == 0x20) | (symbols == 0x0A))
    cut = pa.py_buffer(np.append(0, ends + 1).astype(np.int64))  # a word keeps the space behind it
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, cut, pa.py_buffer(data)]).dictionary_encode()
    _, cut, distinct = coded.dictionary.buffers()
    cut, distinct = np.frombuffer(cut, np.int64)[: len(coded.dictionary) + 1].tolist(), distinct.to_pybytes()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(distinct[a:b]) for a, b in pairwise(cut)), np.uint64, len(cut) - 1)
    counts = np.diff(np.append(-1, np.flatnonzero(symbols[ends] == 0x0A)))
    return _Words(data, ends, coded.indices.to_numpy(), counts, hashes)


def word_runs(flat: np.ndarray, place: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length 1 to `most`: hashes of the runs of words that end at a position, and the positions that have one.

    `flat` has the words' hashes, `place` their places in their texts.
    """
    keys = flat
    for length in range(1, most + 1):
        if length > 1:
            longer = flat.copy()
            mixed = keys[:-1] * _MIX
            mixed ^= mixed >> np.uint64(29)
            longer[1:] += mixed
            keys = longer * _MIX
        yield keys, place >= length - 1


def _counted(trained: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of both, sorted, and how often they are among the first."""
    unseen = np.unique(others)
    return merged(np.unique(trained, return_counts=True), (unseen, np.zeros(len(unseen), np.int64)))


def _packed(values: np.ndarray) -> bytes:
    """Sorted numbers as gaps of the fewest bytes that hold all of them."""
    gaps = np.diff(values, prepend=np.uint64(0))
    width = max(1, -(-int(gaps.max()).bit_length() // 8))
    return gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, : len(data) // n] = np.frombuffer(data, np.uint8).reshape(n, -1)
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64)


def _packed_counts(n: np.ndarray) -> bytes:
    """Counts as a bit for each that says whether it is one, a byte for each other, and eight for those of 255 and more."""
    one = n == 1
    some = n[~one]
    return b"".join(
        [len(n).to_bytes(8, "little"), np.packbits(one).tobytes(), np.minimum(some, 255).astype(np.uint8).tobytes(), some[some >= 255].astype("<i8").tobytes()]
    )


def _unpacked_counts(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    at = 8 + (size + 7) // 8
    others = np.flatnonzero(np.unpackbits(np.frombuffer(data[8:at], np.uint8), count=size) == 0)
    some = np.frombuffer(data, np.uint8, len(others), at).astype(np.int64)
    some[some == 255] = np.frombuffer(data[at + len(others) :], "<i8")
    n = np.ones(size, np.int64)
    n[others] = some
    return n


def _send(split: int, most: int):
    """Of a chunk: its distinct runs of words and their training counts, packed by bucket.

    The highest `split` bits of a hash are its bucket; runs of each length have buckets of their own.
    """

    def run(key, rows):
        words = _words(rows["text"])
        trained = np.repeat(~rows["held_out"].to_numpy().astype(bool), words.counts)
        sent = {"bucket": [], "words": [], "counts": []}
        for length, (keys, has) in enumerate(word_runs(words.hashes[words.numbers], runs(words.counts)[1], most)):
            values, n = _counted(keys[has & trained], keys[has & ~trained])
            bucket = (values >> np.uint64(64 - split)).astype(np.int64)
            rest = (values << np.uint64(split)) >> np.uint64(64 - _RUN_BITS if length else split)
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else bucket
            for a, b in zip(starts, np.append(starts[1:], len(bucket)), strict=len(bucket) > 0):
                sent["bucket"].append((length << split) + int(bucket[a]))
                sent["words"].append(_packed(rest[a:b]))
                sent["counts"].append(_packed_counts(n[a:b]))
        return pa.table(
            {
                "bucket": pa.array(sent["bucket"], pa.int64()),
                "chunk": np.full(len(sent["bucket"]), key[0].as_py(), np.int64),
                "words": pa.array(sent["words"], pa.binary()),
                "counts": pa.array(sent["counts"], pa.binary()),
            }
        )

    return run


def _sum(split: int):
    """Of a bucket: the corpus's counts, back to each chunk in the order they came in; chunk -1 gets sums over words."""

    def run(key, rows):
        n = [_unpacked_counts(c) for c in rows["counts"].to_pylist()]
        ends = np.cumsum([len(c) for c in n])
        values = np.concatenate([_unpacked(w, len(c)) for w, c in zip(rows["words"].to_pylist(), n, strict=True)])
        order = np.argsort(values, kind="stable")
        values = values[order]
        first = np.append(True, values[1:] != values[:-1])
        total = np.add.reduceat(np.concatenate(n)[order], np.flatnonzero(first))
        back = np.empty(len(order), np.int64)
        back[order] = total[np.cumsum(first) - 1]
        counts = [_packed_counts(back[e - len(c) : e]) for e, c in zip(ends, n, strict=True)]
        chunks, facts = rows["chunk"].to_numpy(), np.zeros(3, np.int64)
        if not key[0].as_py() >> split:
            chunks, counts = np.append(chunks, -1), [*counts, b""]
            facts = np.array([np.count_nonzero(total), total.sum(), np.count_nonzero(total == 1)], np.int64)
        at = chunks == -1
        return pa.table(
            {
                "chunk": chunks,
                "bucket": np.full(len(chunks), key[0].as_py(), np.int64),
                "counts": pa.array(counts, pa.binary()),
                "distinct": facts[0] * at,
                "total": facts[1] * at,
                "once": facts[2] * at,
            }
        )

    return run


def _score(tree, total: int, distinct: int, once: int, mixed: float, split: int, most: int):
    unknown = max(once, 1) / (total + 1)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(rows, returned):
        if not len(rows):
            return pa.table({n: pa.array([], t) for n, t in zip(names, _types(rows), strict=True)})
        words = _words(rows["text"])
        counts = words.counts
        spelled = np.diff(np.append(0.0, np.cumsum(tree.value.log10_of(words.data))[words.ends]))
        bucket, sums = returned["bucket"].to_numpy(), returned["counts"].to_pylist()
        order = np.argsort(bucket)
        for length, (keys, has) in enumerate(word_runs(words.hashes[words.numbers], runs(counts)[1], most)):
            here = [_unpacked_counts(sums[i]) for i in order if bucket[i] >> split == length]
            here = np.concatenate([np.zeros(0, np.int64), *here])
            if not length:
                c = words_seen = here[np.unique(words.hashes, return_inverse=True)[1]][words.numbers]
                with np.errstate(divide="ignore"):
                    share = np.log(mixed * c / max(1, total))
                each = np.logaddexp(share, math.log(1 - mixed) + spelled * math.log(10))
                each = np.where(c > 0, each + math.log(max(1 - unknown, 1e-300)), math.log(unknown))
            else:  # the context is the run of words that ends one position before
                c = np.zeros(len(keys), np.int64)
                c[has] = here[np.unique(keys[has], return_inverse=True)[1]]
                at = np.flatnonzero(has & (np.append(0, before[:-1]) >= LEAST_SEEN))
                with np.errstate(divide="ignore"):
                    each[at] = np.logaddexp(np.log(c[at]), math.log(WORD_PRIOR) + each[at]) - np.log(before[at - 1] + WORD_PRIOR)
            before = c
        base = np.log10((words_seen + 1) / (total + distinct + 1))
        starts = np.cumsum(counts) - counts
        values = [
            rows["doc_id"].combine_chunks(),
            rows["held_out"].combine_chunks(),
            counts,
            np.add.reduceat((words_seen > 0).astype(np.int64), starts),
            np.full(len(counts), total, np.int64),
            np.add.reduceat(base, starts),
            np.add.reduceat(each / math.log(10), starts),
        ]
        return pa.table(dict(zip(names, values, strict=True)))

    return run


def _types(rows: pa.Table) -> list[pa.DataType]:
    return [rows.schema.field("doc_id").type, pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2]


def score(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", mixed: float = MIXED, context_words: int = CONTEXT_WORDS
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows where `held_out` is true are scored but not learned from. NULL texts are empty and have
    one token, the end. Rows are independent: repeated rows and NULL ids are
    documents like others. Empty tables give no rows; other columns are left out.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out.alias("held_out"), text_of(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    chunks, buckets = (max(FEWEST, math.ceil(size / n)) for n in (CHUNK_BYTES, BUCKET_BYTES))
    split, most = math.ceil(math.log2(buckets)), context_words + 1
    kind = dict(rows.dtypes)["doc_id"]
    tree = docs.sparkSession.sparkContext.broadcast(learn_tree(rows.where(~F.col("held_out")).select("text")))
    placed = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    sent = placed.groupBy("chunk").applyInArrow(_send(split, most), "bucket bigint, chunk bigint, words binary, counts binary")
    summed = sent.groupBy("bucket").applyInArrow(_sum(split), "chunk bigint, bucket bigint, counts binary, distinct bigint, total bigint, once bigint")
    returned = written(summed, "words")
    facts = returned.where("chunk = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "distinct", "once")]).head()
    scored = (
        placed.groupBy("chunk")
        .cogroup(returned.where("chunk >= 0").select("chunk", "bucket", "counts").groupBy("chunk"))
        .applyInArrow(
            _score(tree, *facts, mixed, split, most),
            f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        )
    )
    return scored


def report(docs: DataFrame) -> DataFrame:
    return score(docs, remainder("doc_id", 7) == 2)
