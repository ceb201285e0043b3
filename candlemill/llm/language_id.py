"""Language of a text by character language models.

Method: each language has an interpolated Kneser-Ney model over the letters of its words. A word
is its lower-cased letters and an end, the context of a letter the letters before it in its word
and the word's beginning, ORDER - 1 at most. Lower orders count in how many contexts a
letter was new; what begins a word, which nothing precedes, keeps its plain counts. A model is
two sorted arrays of hashes: grams with their interpolated log probability, and contexts with
the log weight of the order below. The language of a text is the one with the lowest
cross-entropy per symbol.

Calibration uses sampled documents that the models were not fitted on: a logistic curve over
the lead of the best language on the second, times the square root of the length, gives the score, which is a half
where nothing leads; for each language and class of lengths, a text whose cross-entropy lies above nearly all of
those documents' is rejected, as no text of a known language.

Models are fitted on a bounded sample, `SAMPLE_ROWS` documents, shared evenly between the
languages. Counting is Spark's; what reaches the driver are the distinct grams of that sample.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.session import written

from .common import byte_slices, fresh, pieces, remainder, text_of

ORDER = 5
SAMPLE_ROWS = 20_000  # documents the models are fitted and calibrated on, about; all if there are fewer
HELD_OUT_OF, CALIBRATION = 5, 1  # remainder 0 is held out, remainder 1 calibrates
REJECTED = 0.005  # of the calibrating documents, the share that rejection would lose
UNKNOWN = "und"

_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_BEGIN, _END = "\x02", "\x03"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CACHED = 150_000  # words a task remembers, and the longest of them
_CACHED_LENGTH = 40
_LENGTHS = 8  # classes of lengths: below 4, 16, 64, ... symbols


def words_of(text: bytes) -> list[str]:
    return _LETTERS.findall(text.decode(errors="replace").lower())


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, list[bytes]]]:
    for batch in batches:
        for start, some in byte_slices(batch["text"]):
            yield batch, start, some


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the longest grams that end at each symbol."""

    def counted() -> pa.RecordBatch:
        grams: Counter[tuple[str, str]] = Counter()
        for lang, found in words.items():
            for word, n in found.items():
                symbols = f"{_BEGIN}{word}{_END}"
                for end in range(2, len(symbols) + 1):
                    grams[lang, symbols[max(0, end - ORDER) : end]] += n
        words.clear()
        return pa.RecordBatch.from_pydict(
            {"lang": pa.array([k[0] for k in grams], pa.string()), "gram": pa.array([k[1] for k in grams], pa.string()), "n": pa.array(grams.values(), pa.int64())}
        )

    words: dict[str, Counter[str]] = {}
    for batch, start, some in _texts(batches):
        for lang, text in zip(batch["lang"].slice(start, len(some)).to_pylist(), some, strict=True):
            for piece in pieces(text):
                words.setdefault(lang, Counter()).update(words_of(piece))
        if sum(map(len, words.values())) > 100_000:
            yield counted()
    yield counted()


def _hashes(symbols: np.ndarray) -> np.ndarray:
    """Hash of each row of symbols (code points, 0 before the first)."""
    out = np.zeros(len(symbols), np.uint64)
    for column in symbols.T:
        out = (out + column.astype(np.uint64)) * _BASE
        out ^= out >> np.uint64(29)
    return out


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


class Model:
    """Sorted hashes of grams with log probabilities, and of contexts with log weights of the order below."""

    def __init__(self, grams: list[str], counts: np.ndarray, order: int = ORDER):
        width = order
        rows = np.zeros((len(grams), width), np.uint32)
        for i, gram in enumerate(grams):
            rows[i, width - len(gram) :] = np.frombuffer(gram.encode("utf-32-le"), np.uint32)
        n = counts.astype(np.float64)
        self.order = order
        levels: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(order, 0, -1):
            # Of k symbols here: those counted, which begin a word unless k is the order, and the ends of longer ones.
            here = rows[:, width - k] != 0
            if k < order:
                here &= rows[:, width - k - 1] == 0
            some, weight = rows[here], n[here]
            if levels:
                ends = levels[-1][0].copy()
                ends[:, width - k - 1] = 0
                some, weight = np.concatenate([some, ends]), np.concatenate([weight, np.ones(len(ends))])
            distinct, place = np.unique(some, axis=0, return_inverse=True)
            levels.append((distinct, np.bincount(place.ravel(), weight, len(distinct))))
        self.floor = -math.log(len(levels[-1][0]) + 1)  # any symbol, the unknown one included
        keys, logs, contexts, weights = [], [], [], []
        below_keys, below = np.zeros(0, np.uint64), np.zeros(0)
        for k, (some, weight) in enumerate(reversed(levels), 1):
            cut = _discount(weight)
            context = some.copy()
            context[:, 1:], context[:, 0] = some[:, :-1], 0
            of = _hashes(context)
            each, place = np.unique(of, return_inverse=True)
            total = np.bincount(place, weight)
            spare = np.bincount(place, np.minimum(weight, cut)) / total
            if k == 1:
                lower = np.full(len(some), math.exp(self.floor))
            else:
                end = some.copy()
                end[:, width - k] = 0
                lower = below[np.searchsorted(below_keys, _hashes(end))]
            probability = np.maximum(weight - cut, 0) / total[place] + spare[place] * lower
            own = _hashes(some)
            order_of = np.argsort(own)
            below_keys, below = own[order_of], probability[order_of]
            keys.append(own)
            logs.append(np.log(probability))
            contexts.append(each)
            weights.append(np.log(spare))
        self.grams, self.logs = _sorted(keys, logs)
        self.contexts, self.weights = _sorted(contexts, weights)

    def symbol_logs(self, windows: list[np.ndarray]) -> np.ndarray:
        """Log probability of each symbol; windows[k]: hashes of the k symbols up to it, of 0 symbols first."""
        out = np.zeros(len(windows[0]))
        left = np.arange(len(out))
        for k in range(self.order, 0, -1):
            known, at = _find(self.grams, windows[k][0][left])
            out[left[known]] += self.logs[at[known]]
            left = left[~known]
            if not len(left):
                return out
            # An order that the word is too short for has the context of the one below, with no weight of its own.
            has = windows[k][2][left]
            known, at = _find(self.contexts, windows[k][1][left])
            known &= has
            out[left[known]] += self.weights[at[known]]
        out[left] += self.floor
        return out


def _sorted(hashes: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.concatenate([np.zeros(0, np.uint64), *hashes])
    order = np.argsort(flat)
    return flat[order], np.concatenate([np.zeros(0), *values])[order].astype(np.float32)


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return table[at] == wanted, at


def word_logs(models: list[Model], words: list[str]) -> np.ndarray:
    """Log probability of each word, its end included, in each language."""
    if not words:
        return np.zeros((0, len(models)))
    order = models[0].order
    # Beginnings stand between the words; nothing before one belongs to the word.
    text = np.frombuffer("".join(f"{_BEGIN}{w}{_END}" for w in words).encode("utf-32-le", "replace"), np.uint32)
    begins = np.flatnonzero(text == ord(_BEGIN))
    place = np.arange(len(text)) - np.repeat(begins, np.diff(np.append(begins, len(text))))
    here = np.flatnonzero(place)
    place = place[here]
    symbols = np.zeros((len(here), order), np.uint32)
    for i in range(order):
        inside = place >= i
        symbols[inside, order - 1 - i] = text[here[inside] - i]
    windows: list = [here]
    for k in range(1, order + 1):
        some = symbols.copy()
        some[:, : order - k] = 0
        context = np.zeros_like(some)
        context[:, 1:] = some[:, :-1]
        # A word's beginning and `place` symbols are all there is to see.
        windows.append((_hashes(some), _hashes(context), place >= k - 1))
    starts = np.flatnonzero(place == 1)
    return np.stack([np.add.reduceat(m.symbol_logs(windows), starts) for m in models], axis=1)


class _Scorer:
    """Sums over the words of texts; remembers the words it has met."""

    def __init__(self, models: list[Model]):
        self.models, self.places = models, {}
        self.logs = np.zeros((0, len(models)))

    def entropies(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per symbol in each language, and the number of symbols (0: no letter)."""
        found, owner = [], []
        for i, text in enumerate(texts):
            for piece in pieces(text):
                found.append(words_of(piece))
                owner.append(i)
        if len(self.places) > _CACHED:
            self.places, self.logs = {}, self.logs[:0]
        places = self.places
        new = list({w for words in found for w in words} - places.keys())
        if new:
            places.update(zip(new, range(len(self.logs), len(self.logs) + len(new)), strict=True))
            self.logs = np.concatenate([self.logs, *(word_logs(self.models, new[i : i + 20_000]) for i in range(0, len(new), 20_000))])
        sums, symbols = np.zeros((len(texts), len(self.models))), np.zeros(len(texts), np.int64)
        for i, words in zip(owner, found, strict=True):
            if words:
                sums[i] += self.logs[np.fromiter(map(places.__getitem__, words), np.int64, len(words))].sum(axis=0)
                symbols[i] += sum(map(len, words)) + len(words)
        for word in [w for w in new if len(w) > _CACHED_LENGTH]:
            del places[word]
        return -sums / np.maximum(symbols, 1)[:, None], symbols


def _length_class(symbols: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(symbols, 1)) // 2, _LENGTHS - 1).astype(np.int64)


class Identifier:
    """Models of the languages, the steepness of the score's curve and the bounds of rejection."""

    def __init__(self, languages: list[str], models: list[Model]):
        self.languages, self.models = languages, models
        self.steepness = 1.0
        self.bounds = np.full((len(languages), _LENGTHS), np.inf)

    def calibrate(self, best: np.ndarray, lead: np.ndarray, entropy: np.ndarray, symbols: np.ndarray, right: np.ndarray) -> None:
        """Fits the curve to whether `best` was right, and the bounds to the entropies where it was."""
        if not len(best):
            return
        x, wrong = lead * np.sqrt(symbols), int((~right).sum())
        y = np.where(right, (len(x) - wrong + 1) / (len(x) - wrong + 2), 1 / (wrong + 2))

        def rises(steepness: float) -> bool:
            return float(((1 / (1 + np.exp(-np.minimum(steepness * x, 500))) - y) * x).sum()) > 0

        low, high = 1e-6, 1e6  # the loss is convex: its slope crosses zero once
        for _ in range(60):
            middle = math.sqrt(low * high)
            low, high = (low, middle) if rises(middle) else (middle, high)
        self.steepness = low
        least = math.ceil(1 / REJECTED)
        for i in range(len(self.languages)):
            mine = right & (best == i)
            loosest = np.inf  # longer texts vary less
            for c in range(_LENGTHS):
                some = entropy[mine & (_length_class(symbols) == c)]
                if len(some) >= least:
                    loosest = min(loosest, float(np.quantile(some, 1 - REJECTED, method="higher")))
                self.bounds[i, c] = loosest

    def judge(self, entropies: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its lead on the second, score and rejection."""
        best = entropies.argmin(axis=1)
        lowest = entropies[np.arange(len(best)), best]
        lead = np.partition(entropies, 1, axis=1)[:, 1] - lowest if len(self.languages) > 1 else np.full(len(best), 10.0)
        score = 1 / (1 + np.exp(-np.minimum(self.steepness * lead * np.sqrt(symbols), 500)))
        return best, lead, score, lowest > self.bounds[best, _length_class(symbols)]


def _sampled(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int) -> DataFrame:
    """(text, lang, calibrates) of documents of known language that are not held out, about `rows`.

    Of each language those with the smallest hashes of id and text are taken, as many of each, or all.
    """
    kept = docs.where(F.col(f"`{lang_col}`").isNotNull() & ~held_out(id_col))
    known = kept.select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        text_of(text_col).alias("text"),
        (remainder(id_col, HELD_OUT_OF) == CALIBRATION).alias("calibrates"),
        F.pmod(F.xxhash64(f"`{id_col}`", text_of(text_col)), F.lit(1 << 30)).alias("place"),
    )
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    each = rows // max(1, sizes.count())
    shares = sizes.select("lang", (F.lit(float(1 << 30)) * each / F.col("n")).alias("most"))
    return known.join(F.broadcast(shares), "lang").where("place < most").select("text", "lang", "calibrates")


def held_out(id_col: str = "doc_id") -> Column:
    return remainder(id_col, HELD_OUT_OF) == 0


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS
) -> Identifier:
    """Models of all languages that documents outside the held-out fifth carry, in order of their names.

    Texts without letters teach nothing; a language of which no sampled document has letters is not learned.
    """
    spark = docs.sparkSession
    sample = written(_sampled(docs, id_col, text_col, lang_col, rows), "language-sample")
    counts = sample.where("not calibrates").select("lang", "text").mapInArrow(_gram_counts, "lang string, gram string, n bigint")
    table = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(table["lang"].unique().to_pylist())
    models = []
    for lang in languages:
        mine = table.filter(pa.compute.equal(table["lang"], lang))
        models.append(Model(mine["gram"].to_pylist(), mine["n"].to_numpy()))
    found = Identifier(languages, models)
    if languages:
        shared = spark.sparkContext.broadcast(found)

        def trial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = _Scorer(shared.value.models)
            for batch, start, some in _texts(batches):
                entropies, symbols = scorer.entropies(some)
                best, lead, _, _ = shared.value.judge(entropies, symbols)
                lang = np.array([languages[i] for i in best], object)
                right = lang == np.array(batch["lang"].slice(start, len(some)).to_pylist(), object)
                rows = {"best": best, "lead": lead, "entropy": entropies.min(axis=1), "symbols": symbols, "right": right}
                yield pa.RecordBatch.from_pydict(rows).filter(pa.array(symbols > 0))

        kind = "best bigint, lead double, entropy double, symbols bigint, right boolean"
        rows = sample.where("calibrates").select("lang", "text").mapInArrow(trial, kind).toArrow()
        found.calibrate(*(rows[c].to_numpy() for c in ("best", "lead", "entropy", "symbols", "right")))
        shared.unpersist()
    return found


def _identify(shared: Broadcast, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        scorer = _Scorer(found.models)
        for batch, start, some in _texts(batches):
            kept = [batch[c].slice(start, len(some)) for c in columns]
            if found.models:
                entropies, symbols = scorer.entropies(some)
                best, _, score, rejected = found.judge(entropies, symbols)
                lang = [found.languages[i] if n else UNKNOWN for i, n in zip(best, symbols, strict=True)]
                lowest, known = entropies.min(axis=1), symbols > 0
            else:
                lang, known = [UNKNOWN] * len(some), np.zeros(len(some), bool)
                score, lowest, rejected = np.zeros(len(some)), np.zeros(len(some)), known
            yield pa.RecordBatch.from_arrays(
                [
                    *kept,
                    pa.array(lang, pa.string()),
                    pa.array(np.where(known, score, 0.0)),
                    pa.array(np.where(known, lowest, 0.0), mask=~known),
                    pa.array(~known | rejected),
                ],
                [*columns, "lang_pred", "score", "entropy", "rejected"],
            )

    return run


def identify(docs: DataFrame, found: Identifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy, rejected of every document, from its whole text.

    lang_pred is `und`, with score 0 and NULL entropy, where a text is NULL or has no letter, or where no
    language was learned. A text can be rejected, as unlike any learned language, and still have its nearest
    language. Rows that repeat are scored each; other columns are left out.
    """
    name = F.col(f"`{id_col}`")
    rows = docs.select(name.alias("doc_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(found)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _identify(shared, ["doc_id", "held_out"]),
        f"doc_id {kind}, held_out boolean, lang_pred string, score double, entropy double, rejected boolean",
    )


def keep_language(docs: DataFrame, found: Identifier, languages: list[str], id_col: str = "doc_id") -> DataFrame:
    """The documents in one of the languages whose text is not rejected; all columns stay.

    Documents are matched by id: of rows that share an id all stay if one of them does; rows of NULL id go.
    """
    name = fresh(docs, "kept_id")
    kept = identify(docs, found, id_col).where(F.col("lang_pred").isin(languages) & ~F.col("rejected"))
    return docs.join(kept.select(F.col("doc_id").alias(name)).distinct(), F.col(f"`{id_col}`") == F.col(name), "left_semi")
