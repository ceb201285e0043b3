"""Spelling variants: words of a corpus one edit apart, and the frequent form each belongs to.

Method: the vocabulary is a minimised acyclic acceptor A, an edit of one code point a
transducer E, and near pairs are what A . E . A accepts. Before the edit both copies of A are
in the same state, after it they walk on together; so the composition is walked from a state
of A through (state, state) to pairs of states, with no list of candidates.

The walk is split by the state it starts in. The forward acceptor is cut at the states that
`HEAD` code points reach, the backward one at those that the last `TAIL` reach: an edit
beyond the head leaves the head alone, an edit inside it leaves the tail alone. A state
with more than `GROUP` words behind it is replaced by the states one code point further on,
and by small groups for the edits of just that code point; that is repeated until none is left.
Each group is read by one task, its acceptor is built from the sorted words and dropped.

Pairs are not emitted: a task gives each word its number of near words and the best of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.session import written

from .common import byte_slices, pieces, text_of

LEAST_LENGTH, LEAST_COUNT, FACTOR = 7, 2, 10
DAMAGED_OF = 31  # one of so many (document, word) pairs loses a code point
GROUP = 4_000  # words behind a starting state

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_FLUSH = 200_000  # distinct words a task holds


def _word_counter(least: int, damaged_of: int):
    run_of = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for start, some in byte_slices(batch["text"]):
                for doc, text in zip(batch["id"].slice(start, len(some)).to_pylist(), some, strict=True):
                    runs: Counter[str] = Counter()
                    for piece in pieces(text):
                        runs.update(run_of.findall(piece.translate(_LOWER).decode(errors="replace")))
                    seed = zlib.crc32(f"{doc}:".encode())
                    for word, n in runs.items():
                        h = zlib.crc32(word.encode(), seed)
                        if damaged_of and h % damaged_of == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                        counts[word] += n
                if len(counts) > _FLUSH:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    return run


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    damaged_of: int = DAMAGED_OF,
) -> DataFrame:
    """(word, n): maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lowered, counted over all documents.

    A word whose crc32 with its document's id is divisible by `damaged_of` loses a code point
    first (0: none does). NULL texts hold no words, a NULL id counts as the empty text.
    """
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), text_of(text_col).alias("text"))
    counts = rows.mapInArrow(_word_counter(least_length, damaged_of), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Acceptor:
    """Minimal acyclic acceptors with shared states, each built from sorted distinct strings."""

    def __init__(self):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}

    def _state(self) -> int:
        self.arcs.append({})
        self.final.append(False)
        return len(self.arcs) - 1

    def add(self, strings: list[str]) -> int:
        """The initial state of an acceptor of the strings."""
        root = self._state()
        path, last = [root], ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                state = path.pop()
                key = (self.final[state], *self.arcs[state].items())
                self.arcs[path[-1]][last[len(path) - 1]] = self._known.setdefault(key, state)

        for string in strings:
            same = 0
            for a, b in zip(string, last):  # noqa: B905 - up to the shorter
                if a != b:
                    break
                same += 1
            close(same)
            for symbol in string[same:]:
                state = self._state()
                self.arcs[path[-1]][symbol] = state
                path.append(state)
            self.final[path[-1]] = True
            last = string
        close(0)
        return root

    def common(self, p: int, q: int, without: str = "") -> Iterator[str]:
        """Strings accepted from both states; none that begins with `without`."""
        arcs, final = self.arcs, self.final
        if final[p] and final[q]:
            yield ""
        symbols: list[str] = []
        below = [(0, a, r, arcs[q][a]) for a, r in arcs[p].items() if a in arcs[q] and a != without]
        while below:
            depth, a, p, q = below.pop()
            del symbols[depth:]
            symbols.append(a)
            if final[p] and final[q]:
                yield "".join(symbols)
            here, there = arcs[p], arcs[q]
            if p == q:
                below += [(depth + 1, b, r, r) for b, r in here.items()]
            else:
                below += [(depth + 1, b, r, there[b]) for b, r in here.items() if b in there]

    def near(self, root: int, strings: list[str]) -> Iterator[tuple[str, str]]:
        """Pairs of the sorted strings, accepted from `root`, that are one edit apart; each once.

        The composition's states before the edit are pairs (q, q); they are visited along the
        strings, each prefix once. Of equal symbols in a row the last counts as inserted.
        """
        arcs, final = self.arcs, self.final
        path, last = [root], None
        for string in strings:
            same = 0
            if last is not None:
                for a, b in zip(string, last):  # noqa: B905 - up to the shorter
                    if a != b:
                        break
                    same += 1
            del path[same + 1 :]
            for depth in range(same if last is None else same + 1, len(string) + 1):
                if depth:
                    path.append(arcs[path[depth - 1]][string[depth - 1]])
                q = path[depth]
                after = list(arcs[q].items())
                if len(after) < 2 and not final[q]:
                    continue  # one way on: both copies take it
                for i, (a, p) in enumerate(after):
                    for rest in self.common(p, q, a):
                        yield f"{string[:depth]}{a}{rest}", f"{string[:depth]}{rest}"
                    for b, r in after[:i]:
                        for rest in self.common(p, r):
                            yield f"{string[:depth]}{a}{rest}", f"{string[:depth]}{b}{rest}"
            last = string


_STATES = 200_000  # states shared by groups before they are dropped


def _composed(head: int):
    """Rows sorted by group and word: near words of each word, and the best of them.

    A pair counts in one group only: forward if the heads are equal, else backward; in groups
    for the edits of one code point only if the words part there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, group, words, counts = Acceptor(), None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal machine
            if len(words) > 1:
                back, at, exact = group[0] == "b", group[1], group[2]
                rests = [w[at:] for w in words]
                root = machine.add(rests)
                size = dict(zip(rests, counts, strict=True))
                near: Counter[str] = Counter()
                best: dict[str, tuple[int, str]] = {}
                start = words[0][:at]
                for x, y in machine.near(root, rests):
                    if exact and x[:1] == y[:1]:
                        continue
                    if back and (start + x)[: -head - 1 : -1] == (start + y)[: -head - 1 : -1]:
                        continue
                    for a, b in ((x, y), (y, x)):
                        near[a] += 1
                        rank = (-size[b], (start + b)[::-1] if back else start + b)
                        if a not in best or rank < best[a]:
                            best[a] = rank
                full = [(start + a)[::-1] if back else start + a for a in near]
                ranks = [best[a] for a in near]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full, pa.string()),
                        pa.array(near.values(), pa.int64()),
                        pa.array([-n for n, _ in ranks], pa.int64()),
                        pa.array([w for _, w in ranks], pa.string()),
                    ],
                    ["word", "n_near", "near_n", "near_word"],
                )
                if len(machine.arcs) > _STATES:
                    machine = Acceptor()
            words.clear()
            counts.clear()

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("side", "at", "exact", "key", "word", "n")]
            for side, at, exact, key, word, n in zip(*columns, strict=True):
                if (side, at, exact, key) != group:
                    yield from close()
                    group = (side, at, exact, key)
                words.append(word)
                counts.append(n)
        yield from close()

    return run


_GROUP = ["side", "at", "exact", "key"]


def _prefix(length: Column | int) -> Column:
    return F.substring("word", F.lit(1), F.lit(length) if isinstance(length, int) else length)


def _split(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """The words of too large groups, in groups one code point further on and groups for its edits."""
    large = rows.join(hot, _GROUP, "left_semi")
    start = _prefix(F.col("at"))
    further = F.struct("side", (F.col("at") + 1).alias("at"), F.lit(False).alias("exact"), _prefix(F.col("at") + 1).alias("key"))

    def part(beyond: int) -> Column:
        rest = F.substring("word", F.col("at") + F.lit(1 + beyond), F.length("word"))
        return F.struct("side", "at", F.lit(True).alias("exact"), F.concat(start, F.lit("\0"), rest).alias("key"))

    # With the code point at this place left out, and as it is, for words that lack one there.
    return large.select(F.explode(F.array(further, part(1), part(0))).alias("g"), "word", "n").select("g.*", "word", "n")


def _groups(words: DataFrame, head: int, tail: int, most: int) -> DataFrame:
    """Every word behind the starting states it takes part in, none with more than `most` words."""
    sides = F.array(
        F.struct(F.lit("f").alias("side"), F.lit(head).alias("at"), F.col("word").alias("turned")),
        F.struct(F.lit("b").alias("side"), F.lit(tail).alias("at"), F.reverse("word").alias("turned")),
    )
    rows = words.select(F.explode(sides).alias("s"), "n").select("s.side", "s.at", F.lit(False).alias("exact"), F.col("s.turned").alias("word"), "n")
    rows = rows.select("side", "at", "exact", _prefix(F.col("at")).alias("key"), "word", "n")
    done = None
    while True:
        sizes = rows.groupBy(*_GROUP).agg(F.count("*").alias("size"))
        hot = written(sizes.where((F.col("size") > most) & ~F.col("exact")).drop("size"), "hot-states")
        none = hot.isEmpty()
        small = rows if none else rows.join(hot, _GROUP, "left_anti")
        done = small if done is None else done.unionByName(small)
        if none:
            return done
        rows = written(_split(rows, hot), "split-states")


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, most: int = GROUP) -> DataFrame:
    """(word, n_near, near_n, near_word) of the words that have near words, from (word, n) with distinct words.

    near_word is the near word of largest n, of equal ones the smallest. Words have at least
    `least_length` (two or more) code points.
    """
    head = least_length // 2
    ordered = _groups(words, head, least_length - head, most).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "word")
    found = ordered.mapInArrow(_composed(head), "word string, n_near bigint, near_n bigint, near_word string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near_word")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near_word").alias("near_word")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form; every round doubles the steps.

    n grows by the factor at each step, so chains are short and end.
    """
    roots = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        on = written(roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if on.where("moved").isEmpty():
            return on.select("word", "root")
        roots = on.select("word", "root")


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    factor: int = FACTOR,
    damaged_of: int = DAMAGED_OF,
    most: int = GROUP,
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    form is the near word of largest n (ties: the smallest) if that is `factor` (above one) times the
    word's n or more, else NULL; root is the last of the chain of forms, the word itself
    without one. See `vocabulary` for NULLs; repeated rows count each; tables without words
    give no rows; further columns are not read.
    """
    words = written(vocabulary(docs, id_col, text_col, least_length, least_count, damaged_of), "vocabulary")
    taken = F.col("near_n") >= factor * F.col("n")
    near = words.join(near_words(words, least_length, most), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(taken, F.col("near_word")).alias("form"),
        F.when(taken, F.col("near_n")).alias("form_n"),
    )
    near = written(near, "near-words")
    roots = _roots(near.where("form is not null"))
    return near.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
