"""Quality classifier: a sparse ensemble of rules over text statistics.

Method: shallow random trees are grown on the statistics of a bounded labelled sample;
every path from a root to a node is a rule, a conjunction of comparisons. A logistic
regression with an L1 penalty gives most rules weight zero; the rest become one Spark
column expression, so that scoring needs no model object beyond the plan.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from candlemill.session import written

from .common import byte_slices, fresh, text_of
from .labelled import SAMPLE_ROWS, held_out, training_sample

THRESHOLD = 0.3
STATISTICS = (
    "words", "word_length", "upper", "digits", "marks", "symbols", "bars", "exclamations", "distinct", "top_word",
    "repeats", "upper_words", "line_words", "line_repeats", "stopped_words",
)
Path = tuple[tuple[int, float, bool], ...]  # statistic, threshold, above?


def statistics(text: bytes) -> list[float]:
    """Numbers in the order of STATISTICS; shares of characters, words or lines where that makes sense."""
    size = max(1, len(text))
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, digits = count[0x41:0x5B].sum(), count[0x30:0x3A].sum()
    marks = count[0x21:0x7F].sum() - upper - digits - count[0x61:0x7B].sum()
    symbols = sum(count[b] for b in b"#$%&*@^~_+=<>\\")
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    known = Counter(words)
    return [
        float(len(words)),
        sum(map(len, words)) / n,
        upper / size,
        digits / size,
        marks / size,
        symbols / size,
        count[0x7C] / size,
        count[0x21] / size,
        len(known) / n,
        max(known.values(), default=0) / n,
        sum(map(bytes.__eq__, words[1:], words)) / n,
        sum(map(bytes.isupper, words)) / n,
        n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(w.endswith((b".", b"!", b"?")) for w in words) / n,
    ]


@F.arrow_udf(ArrayType(DoubleType()))
def _statistics(text: pa.Array) -> pa.Array:
    rows = [statistics(t) for _, some in byte_slices(text) for t in some]
    return pa.array(rows, pa.list_(pa.float64()))


def with_statistics(docs: DataFrame, out: str, text_col: str = "text") -> DataFrame:
    return docs.withColumn(out, _statistics.asNondeterministic()(text_of(text_col)))


@dataclass
class Rules:
    """Rules with their weights, and the intercept."""

    weights: dict[Path, float] = field(default_factory=dict)
    intercept: float = 0.0

    def column(self, statistics: Column) -> Column:
        """Probability of label 1."""
        terms = [F.when(_holds(p, statistics), F.lit(w)).otherwise(F.lit(0.0)) for p, w in self.weights.items()]
        log_odds = reduce(lambda a, b: a + b, terms, F.lit(self.intercept))
        return 1 / (1 + F.exp(-log_odds))

    def described(self) -> list[str]:
        """The rules in words, the heaviest first."""
        said = []
        for path, weight in sorted(self.weights.items(), key=lambda x: -abs(x[1])):
            said.append(f"{weight:+.3f} if " + " and ".join(f"{STATISTICS[i]} {'>' if up else '<='} {t:.4g}" for i, t, up in path))
        return said


def _holds(path: Path, statistics: Column) -> Column:
    tests = [statistics[i] > t if above else statistics[i] <= t for i, t, above in path]
    return reduce(lambda a, b: a & b, tests)


def tree_paths(node, path: Path = ()) -> list[Path]:
    """Paths to all nodes below a root of Spark's trees; a later bound of one statistic replaces an earlier one."""
    found = [path] if path else []
    if node.subtreeDepth():
        split = node.split()
        for child, above in ((node.leftChild(), False), (node.rightChild(), True)):
            test = (int(split.featureIndex()), float(split.threshold()), above)
            rest = tuple(t for t in path if (t[0], t[2]) != (test[0], test[2]))
            found += tree_paths(child, tuple(sorted((*rest, test))))
    return found


def fit(sample: DataFrame, trees: int = 20, depth: int = 3, penalty: float = 2e-4, seed: int = 7) -> Rules:
    """Rules for the sample's (text, label) rows. With one label only, the score is its share for every text.

    The statistics of the bounded sample are sorted into one file, so that the rules don't
    depend on how the documents lie in partitions.
    """
    rows = with_statistics(sample, "statistics").select("statistics", "label")
    rows = written(rows.repartition(1).sortWithinPartitions("statistics", "label"), "quality-sample")
    total, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).head()
    if ones in (0, total):
        return Rules(intercept=float(np.log((ones + 0.5) / (total - ones + 0.5))))
    points = rows.select("statistics", array_to_vector("statistics").alias("features"), F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=5, seed=seed, subsamplingRate=0.7).fit(points)
    paths = sorted({p for tree in forest._call_java("trees") for p in tree_paths(tree.rootNode())})
    held = [F.when(_holds(p, F.col("statistics")), 1.0).otherwise(0.0) for p in paths]
    ruled = written(points.select("label", array_to_vector(F.array(*held)).alias("features")), "quality-rules")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=60).fit(ruled)
    weights = {p: float(w) for p, w in zip(paths, lasso.coefficients.toArray(), strict=True) if abs(w) > 1e-6}
    return Rules(weights, float(lasso.intercept))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = SAMPLE_ROWS) -> Rules:
    return fit(training_sample(docs, labels, label_col, rows))


def score(docs: DataFrame, rules: Rules, out: str = "quality", text_col: str = "text") -> DataFrame:
    """Add double column `out`, 0 to 1: how likely label 1 is.

    NULL texts count as empty, and empty texts have a score like others. Rows are
    independent: repeated rows, empty tables and other columns need no care; a column
    called `out` is replaced.
    """
    name = fresh(docs, "statistics")
    return with_statistics(docs, name, text_col).withColumn(out, rules.column(F.col(name))).drop(name)


def keep_good(docs: DataFrame, rules: Rules, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that reach the threshold, with their own columns only."""
    name = fresh(docs, "quality")
    return score(docs, rules, name).where(F.col(name) >= threshold).drop(name)


def report(docs: DataFrame, rules: Rules) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), rules, "score")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
