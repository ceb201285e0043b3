"""Toxicity by multiple-instance learning.

Method: a document is a bag of sentences. A sentence's score is the logistic function of
the summed weights of its words; a document's is the noisy-or of its sentences, one
minus the product of their complements. Weights are learned from document labels alone,
so the sentences that explain the label take the blame, and can be named afterwards.

Features are words and the beginnings of words of 4 to 6 letters, which catch inflected
forms. Only features that come more often with the label are kept, at most MAX_FEATURES.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, fresh, small_batches, text_of
from .labelled import SAMPLE_ROWS, held_out, training_sample

MAX_FEATURES = 4096
MIN_SUPPORT = 3  # labelled documents that must hold a feature
THRESHOLD = 0.5
_PREFIXES = (4, 5, 6)
_ENDS = b".!?\n"
_TO_TOKENS = bytes(
    0x2E if b in _ENDS else b if b >= 0x80 or chr(b).isalnum() and b < 0x80 else 0x20 for b in range(256)
)
_SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")


def tokens(text: bytes) -> list[bytes]:
    """Lower-case words, with the token `.` at sentence ends."""
    return text.decode().lower().encode().translate(_TO_TOKENS).replace(b".", b" . ").split()


def features(word: bytes) -> set[str]:
    """The word, and its beginnings, marked by a hyphen."""
    name = word.decode(errors="replace")
    return {name} | {name[:n] + "-" for n in _PREFIXES if len(name) >= n}


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -9.0

    def __post_init__(self):
        self.known: dict[bytes, float] = {b".": float("nan")}

    def __getstate__(self):
        return self.weights, self.bias

    def __setstate__(self, state):
        self.weights, self.bias = state
        self.__post_init__()

    def sentences(self, text: bytes) -> np.ndarray:
        """Log-odds of each sentence that has words."""
        known, found = self.known, tokens(text)
        for w in set(found).difference(known):
            known[w] = sum(self.weights.get(f, 0.0) for f in features(w))
        values = np.fromiter(map(known.__getitem__, found), np.float64, len(found))
        if len(known) > 150_000:
            self.__post_init__()
        ends = np.isnan(values)
        number = np.cumsum(ends) - ends
        used = np.unique(number[~ends])
        return np.bincount(number[~ends], values[~ends])[used] + self.bias

    def score(self, text: bytes) -> float:
        return float(-np.expm1(-np.logaddexp(0, self.sentences(text)).sum()))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int]]:
    """Texts and labels; few texts at a time are Python values."""
    for start, some in byte_slices(batch["text"]):
        yield from zip(some, batch["label"].slice(start, len(some)).to_pylist(), strict=True)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with and without the label that hold each feature, by task."""
    with_label, without = Counter(), Counter()
    for batch in batches:
        for text, label in _rows(batch):
            words = set(tokens(text)) - {b"."}
            (with_label if label else without).update(set().union(*map(features, words)) if words else ())
    names = list(with_label | without)
    for i in range(0, len(names), 10_000):
        some = names[i : i + 10_000]
        yield pa.RecordBatch.from_pydict(
            {"feature": some, "yes": [with_label[f] for f in some], "no": [without[f] for f in some]}
        )


def select_features(sample: DataFrame, most: int = MAX_FEATURES) -> list[str]:
    """Features that come with the label, the most telling first (signed chi-squared)."""
    yes, no = sample.agg(F.sum("label"), F.sum(1 - F.col("label"))).head()
    yes, no = float(yes or 0), float(no or 0)
    if not yes or not no:
        return []
    counts = sample.mapInArrow(_counts, "feature string, yes long, no long").groupBy("feature").agg(
        F.sum("yes").alias("yes"), F.sum("no").alias("no")
    )
    a, b = F.col("yes"), F.col("no")
    c, d = F.lit(yes) - a, F.lit(no) - b
    n = yes + no
    chi = n * F.pow(a * d - b * c, F.lit(2)) / ((a + b) * (c + d + 1) * yes * no)
    chosen = counts.where((a >= MIN_SUPPORT) & (a / yes > 2 * b / no)).select("feature", chi.alias("chi"))
    return [r["feature"] for r in chosen.where("chi > 6").orderBy(F.desc("chi"), "feature").limit(most).collect()]


def _bags(names: list[str]):
    """Per document: for each sentence with features, its feature numbers; and how many have none."""
    numbers = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"label": [], "plain": [], "bags": []}
            for text, label in _rows(batch):
                sentences, words = [[]], 0
                plain = 0
                for w in [*tokens(text), b"."]:
                    if w != b".":
                        words += 1
                        sentences[-1] += [numbers[f] for f in features(w) if f in numbers]
                    elif words:
                        if not sentences[-1]:
                            plain += 1
                            sentences.pop()
                        sentences.append([])
                        words = 0
                out["label"].append(label)
                out["plain"].append(plain)
                out["bags"].append([s for s in sentences if s])
            types = {"label": pa.int32(), "plain": pa.int64(), "bags": pa.list_(pa.list_(pa.int32()))}
            yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in types.items()], list(types))

    return run


def fit(sample: DataFrame, steps: int = 300, rate: float = 0.15, ridge: float = 0.3) -> Model:
    """Gradient steps on the noisy-or likelihood of the sample's document labels.

    `sample` has columns text and label and is bounded (see `training_sample`); the
    driver gets only numbers of selected features. Without both labels nothing is toxic.
    """
    names = select_features(sample)
    if not names:
        return Model()
    rows = sample.mapInArrow(_bags(names), "label int, plain long, bags array<array<int>>").toArrow()
    label = rows["label"].to_numpy().astype(float)
    plain = rows["plain"].to_numpy().astype(float)
    bags = rows["bags"].combine_chunks()
    doc = np.repeat(np.arange(len(label)), np.diff(bags.offsets.to_numpy()))
    inner = bags.values if len(doc) else pa.array([], pa.list_(pa.int32()))
    sentence = np.repeat(np.arange(len(doc)), np.diff(inner.offsets.to_numpy()))
    feature = inner.values.to_numpy(zero_copy_only=False)
    weights, bias = np.full(len(names), 0.5), -6.0
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(sentence, weights[feature], len(doc))
        total = np.bincount(doc, np.logaddexp(0, z), len(label)) + plain * np.logaddexp(0, bias)
        slope = 1 - label - label / np.maximum(np.expm1(total), 1e-9)
        at = slope[doc] / (1 + np.exp(-z))
        grad = np.append(
            np.bincount(feature, at[sentence], len(names)) / len(label) + ridge / len(label) * weights,
            (at.sum() + (slope * plain).sum() / (1 + np.exp(-bias))) / len(label),
        )
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9) * (1 - step / (steps + 1))
        weights, bias = np.maximum(weights - move[:-1], 0), bias - move[-1]
    return Model({f: float(w) for f, w in zip(names, weights, strict=True) if w}, float(bias))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    sample = training_sample(small_batches(docs), labels, label_col, rows).persist()
    try:
        return fit(sample)
    finally:
        sample.unpersist()


def score(docs: DataFrame, model: Model, out: str = "toxicity", text_col: str = "text") -> DataFrame:
    """Add double column `out`, 0 to 1. NULL and empty texts have no sentence and score 0.

    Rows are independent: repeated rows, empty tables and other columns need no care; a
    column called `out` is replaced.
    """
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(text: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(t) for _, some in byte_slices(text) for t in some], pa.float64())

    return docs.withColumn(out, run.asNondeterministic()(text_of(text_col)))


def offending(docs: DataFrame, model: Model, out: str = "offending", text_col: str = "text", least: float = THRESHOLD) -> DataFrame:
    """Add array column `out`: number, score and text of each sentence that scores `least` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<struct<sentence: int, score: double, text: string>>")
    def run(text: pa.Array) -> pa.Array:
        rows = []
        for t in text.to_pylist():
            parts = [p for p in _SENTENCE.findall(t) if set(tokens(p.encode())) - {b"."}]
            scores = 1 / (1 + np.exp(-shared.value.sentences(t.encode())))
            rows.append(
                [
                    {"sentence": i, "score": float(s), "text": p.strip()}
                    for i, (p, s) in enumerate(zip(parts, scores, strict=True))
                    if s >= least
                ]
            )
        kind = pa.struct([("sentence", pa.int32()), ("score", pa.float64()), ("text", pa.string())])
        return pa.array(rows, pa.list_(kind))

    return docs.withColumn(out, run(text_of(text_col)))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that score below the threshold, with their own columns only."""
    name = fresh(docs, "toxicity")
    return score(docs, model, name).where(F.col(name) < threshold).drop(name)


def report(docs: DataFrame, model: Model) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
