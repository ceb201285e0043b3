"""BPE encoding and decoding by speculate and verify.

Method: each distinct word is first cut by greedy longest match. A cut is the exact BPE
result if and only if no merge would cross any of its boundaries, and each boundary
depends on its two tokens alone, so all distinct adjacent pairs of a batch are tested at
once in numpy. Words with a failing pair are merged exactly, merge by merge.

A pair test walks both tokens backwards in time: of the two symbols at the boundary
the one made later is undone, until a merge of the boundary is found that comes before
either symbol is used up (the pair fails), or both sides are single symbols (it holds).

The vocabulary is a file in the format of the tokenizers library: NFC, white space and
lower-case normalisation, the word pattern, byte symbols, merges with an end-of-word
suffix, special tokens matched in the raw text. It is read on the driver through its path
and broadcast (a vocabulary has a fixed size, checked below).
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, text_of

MAX_VOCABULARY = 1_000_000
CACHED_WORDS = 300_000  # per Python worker; the cache is emptied when full
_NEVER = np.int64(1) << 40


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Bpe:
    """A vocabulary, its merges as arrays, and the encoder over them."""

    def __init__(self, definition: dict):
        model = definition["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        if len(self.ids) > MAX_VOCABULARY:
            raise ValueError(f"a vocabulary of {len(self.ids)} tokens is too large to broadcast")
        self.special = {t["content"]: t["id"] for t in definition["added_tokens"]}
        self.names = {i: t for t, i in {**self.ids, **self.special}.items()}
        patterns = [
            p["pattern"]["Regex"] for p in definition["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        ]
        self.pattern = regex.compile(patterns[0])
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.symbols = byte_symbols()
        self._arrays(model["merges"])
        self.cache: dict[str, tuple[int, str, str]] = {}

    def _arrays(self, merges: list) -> None:
        size = max(self.ids.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([self.ids[a] for a, _ in pairs], np.int64)
        right = np.array([self.ids[b] for _, b in pairs], np.int64)
        made = np.array([self.ids[a + b] for a, b in pairs], np.int64)
        self.size = size
        self.made = made
        self.rank = np.full(size, -1, np.int64)  # single symbols come before every merge
        self.left, self.right = np.arange(size), np.arange(size)
        self.rank[made[::-1]] = np.arange(len(pairs))[::-1]
        self.left[made[::-1]], self.right[made[::-1]] = left[::-1], right[::-1]
        keys = left * size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_rank = keys[order], order.astype(np.int64)
        self.merges = {(int(a), int(b)): (r, int(m)) for r, (a, b, m) in enumerate(zip(left, right, made, strict=True))}
        # A token may be proposed only if merging its own characters makes it.
        whole = np.flatnonzero(self.rank >= 0)
        sound = self.compatible(self.left[whole], self.right[whole], self.rank[whole])
        self.sound = np.ones(size, bool)
        for token, fine in zip(whole[np.argsort(self.rank[whole])], sound[np.argsort(self.rank[whole])], strict=True):
            self.sound[token] = fine and self.sound[self.left[token]] and self.sound[self.right[token]]
        self.offered = {t: i for t, i in self.ids.items() if self.sound[i]}
        self.reach: dict[str, int] = {}  # length of the longest token that begins with these three characters
        for t in self.offered:
            n = len(t) - len(self.suffix) if self.suffix and t.endswith(self.suffix) else len(t)
            self.reach[t[:3]] = max(self.reach.get(t[:3], 2), n)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of tokens, or _NEVER; -1 is no token."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.key_rank[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each pair of adjacent tokens: does no merge cross between them (before the given rank)?"""
        a, b = a.copy(), b.copy()
        until_a = np.full(len(a), _NEVER) if before is None else before.copy()
        until_b = until_a - 1 if before is not None else until_a.copy()
        good, open_ = np.ones(len(a), bool), np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            rank = self._ranks(x, y)
            crossed = (rank < until_a[open_]) & (rank <= until_b[open_])
            good[open_[crossed]] = False
            ra, rb = self.rank[x], self.rank[y]
            go = ~crossed & ((ra >= 0) | (rb >= 0))
            # Of equal merges the left one happens first, so the right one is undone first.
            undo_a, undo_b = go & (ra > rb), go & (ra <= rb)
            i, j = open_[undo_a], open_[undo_b]
            until_a[i], a[i] = ra[undo_a], self.right[x[undo_a]]
            until_b[j], b[j] = rb[undo_b], self.left[y[undo_b]]
            open_ = open_[go]
        return good

    def greedy(self, word: str) -> list[int]:
        """Longest known token first; the last one carries the end-of-word suffix."""
        out, at, end, offered, reach = [], 0, len(word), self.offered, self.reach
        while at < end:
            most = min(reach.get(word[at : at + 3], 2), end - at)
            if at + most == end:
                if (token := offered.get(word[at:] + self.suffix)) is not None:
                    out.append(token)
                    break
                most -= bool(self.suffix)
            for n in range(most, 0, -1):
                if (token := offered.get(word[at : at + n])) is not None:
                    out.append(token)
                    at += n
                    break
            else:
                return []
        return out

    def exact(self, words: list[str]) -> list[list[int]]:
        """Merges in rank order, leftmost first, for many words at once."""
        start = [[self.ids[s] for s in (*w[:-1], w[-1] + self.suffix) if s in self.ids] for w in words]
        out: list[list[int]] = start
        lengths = np.fromiter(map(len, start), np.int64, len(start))
        for low, high in ((2, 8), (9, 16), (17, 32), (33, 64)):
            group = np.flatnonzero((lengths >= low) & (lengths <= high))
            for part in np.array_split(group, max(1, len(group) // 20_000)):
                for i, tokens in zip(part, self._merged([start[i] for i in part], high), strict=True):
                    out[i] = tokens
        for i in np.flatnonzero(lengths > 64):
            out[i] = self._merged_long(start[i])
        return out

    def _merged(self, rows: list[list[int]], width: int) -> list[list[int]]:
        """All rows as one matrix; each step does the best merge of every row that has one."""
        if not rows:
            return []
        tokens = np.full((len(rows), width + 1), -1, np.int64)
        for i, r in enumerate(rows):
            tokens[i, : len(r)] = r
        ranks = self._ranks(tokens[:, :-1], tokens[:, 1:])
        columns, live = np.arange(width + 1), np.arange(len(rows))
        while len(live):
            best = ranks[live].argmin(axis=1)
            rank = ranks[live, best]
            live, best, rank = live[rank < _NEVER], best[rank < _NEVER], rank[rank < _NEVER]
            if not len(live):
                break
            shifted = np.minimum(columns + (columns > best[:, None]), width)
            merged = np.take_along_axis(tokens[live], shifted, 1)
            merged[:, -1] = -1
            merged[np.arange(len(live)), best] = self.made[rank]
            tokens[live] = merged
            left = np.take_along_axis(ranks[live], np.minimum(shifted[:, :-1], width - 1), 1)
            left[:, -1] = _NEVER
            ranks[live] = left
            ranks[live, best] = self._ranks(merged[np.arange(len(live)), best], merged[np.arange(len(live)), best + 1])
            inner = best > 0
            rows_, at = live[inner], best[inner] - 1
            ranks[rows_, at] = self._ranks(tokens[rows_, at], tokens[rows_, at + 1])
        return [r[r >= 0].tolist() for r in tokens]

    def _merged_long(self, tokens: list[int]) -> list[int]:
        """One long word: a queue of merges over a linked list."""
        tokens, after, before = list(tokens), [*range(1, len(tokens)), -1], [*range(-1, len(tokens) - 1)]
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (found := self.merges.get((tokens[i], tokens[after[i]]))):
                heappush(queue, (found[0], i, tokens[i], tokens[after[i]]))

        for i in range(len(tokens)):
            offer(i)
        while queue:
            rank, i, a, b = heappop(queue)
            j = after[i]
            if tokens[i] != a or j < 0 or tokens[j] != b:
                continue
            tokens[i], tokens[j], after[i] = self.merges[a, b][1], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [t for t in tokens if t >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of distinct words (each a match of the word pattern)."""
        table = self.symbols
        mapped = ["".join([table[b] for b in w.encode()]) for w in words]
        proposed = [self.greedy(w) for w in mapped]
        counts = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(counts.sum()))
        owner = np.repeat(np.arange(len(words)), counts)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, place = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        fails = ~self.compatible(pairs // self.size, pairs % self.size)[place]
        again = counts == 0
        again[owner[inner[fails]]] = True
        failing = np.flatnonzero(again)
        for i, tokens in zip(failing, self.exact([mapped[i] for i in failing]), strict=True):
            proposed[i] = tokens
        return proposed

    def normal(self, text: str) -> str:
        """NFC, each character lower-cased by itself; what white space there is makes no difference to the words."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # A final sigma depends on its neighbours in str.lower, which works on whole words.
            return text.replace("Σ", "σ").lower()
        return text.lower()

    def learn(self, words: set[str]) -> None:
        """Put the words into the cache: token count, ids as text, tokens as text."""
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache.clear()
            new = list(words)
        for word, tokens in zip(new, self.encode_words(new), strict=True):
            self.cache[word] = (len(tokens), " ".join(map(str, tokens)), " ".join([self.names[t] for t in tokens]))

    def pieces(self, text: str) -> list[tuple[bool, str]]:
        """Words and special tokens (True) in order."""
        if not any(s in text for s in self.special):
            return [(False, w) for w in self.pattern.findall(self.normal(text))]
        out: list[tuple[bool, str]] = []
        for part in self.split_special.split(text):
            if part in self.special:
                out.append((True, part))
            else:
                out += [(False, w) for w in self.pattern.findall(self.normal(part))]
        return out

    def encode_texts(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Token count, ids joined by spaces and decoded text of each text."""
        plain = [not any(s in t for s in self.special) for t in texts]
        cut = [self.pattern.findall(self.normal(t)) if p else self.pieces(t) for t, p in zip(texts, plain, strict=True)]
        self.learn(set().union(*(c if p else [x for s, x in c if not s] for c, p in zip(cut, plain, strict=True))))
        known, out = self.cache, []
        for c, p in zip(cut, plain, strict=True):
            if p:
                found = map(known.__getitem__, c)
            else:
                found = [(1, str(self.special[w]), w) if s else known[w] for s, w in c]
            counts, ids, names = zip(*found, strict=True) if c else ((), (), ())
            if 0 in counts:  # a word of symbols that the vocabulary lacks
                ids, names = ([x for n, x in zip(counts, part, strict=True) if n] for part in (ids, names))
            out.append((sum(counts), " ".join(ids), " ".join(names)))
        return out

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space: the vocabulary names no decoder."""
        return " ".join([self.names[i] for i in ids if i in self.names])


_ENCODED = "struct<n_tokens: bigint, ids: array<int>>"
_LOADED: dict[str, Bpe] = {}


def _load(definition: str) -> Bpe:
    """One encoder per worker process and vocabulary."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(json.loads(definition))
    return _LOADED[key]


def _broadcast(docs: DataFrame, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _parts(encoder: Bpe, text: pa.Array):
    for _, some in byte_slices(text):
        yield from encoder.encode_texts([t.decode() for t in some])


def encode(docs: DataFrame, vocabulary: str, out: str = "encoded", text_col: str = "text") -> DataFrame:
    """Add struct column `out`: n_tokens and ids. NULL and empty texts have no tokens.

    `vocabulary` is the path of a tokenizer file on the driver. Special tokens in a text
    become their ids. Rows are independent: repeated rows, empty tables and other columns
    need no care; a column called `out` is replaced.
    """
    definition = _broadcast(docs, vocabulary)

    @F.arrow_udf(_ENCODED)
    def run(text: pa.Array) -> pa.Array:
        rows = list(_parts(_load(definition.value), text))
        ids = pa.array([np.array(i.split(), np.int32) for _, i, _ in rows], pa.list_(pa.int32()))
        return pa.StructArray.from_arrays([pa.array([n for n, _, _ in rows], pa.int64()), ids], ["n_tokens", "ids"])

    return docs.withColumn(out, run.asNondeterministic()(text_of(text_col)))


def decode(docs: DataFrame, vocabulary: str, out: str = "decoded", ids_col: str = "ids") -> DataFrame:
    """Add string column `out` with the decoded ids; NULL ids give the empty text, unknown ids are left out."""
    definition = _broadcast(docs, vocabulary)

    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        encoder = _load(definition.value)
        return pa.array([encoder.decode(i or []) for i in ids.to_pylist()], pa.string())

    return docs.withColumn(out, run(F.col(ids_col)))


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_tokens and the digests of its ids and of its decoded text.

    Ids and decoded text are made and hashed in the task, so that neither leaves it.
    """
    definition = _broadcast(docs, vocabulary)

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    def run(text: pa.Array) -> pa.Array:
        rows = [
            (n, hashlib.sha256(i.encode()).hexdigest(), hashlib.sha256(d.encode()).hexdigest())
            for n, i, d in _parts(_load(definition.value), text)
        ]
        return pa.StructArray.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[k] for r in rows], pa.string()) for k in (1, 2))],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    made = docs.select(F.col(f"`{id_col}`").alias("doc_id"), run.asNondeterministic()(text_of(text_col)).alias("made"))
    return made.select("doc_id", "made.*")
