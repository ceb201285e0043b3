import random

import numpy as np
from cases import LONG, awkward, clashing, docs, empty

from candlemill.llm import labelled, quality, toxicity

LABELS = "doc_id long, quality int, toxic int"


def labelled_docs(spark, count=400):
    rng, rows, labels = random.Random(6), [], []
    vocabulary = ["".join(rng.choice("aeionst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    for i in range(count):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        bad, toxic = i % 5 == 1, i % 4 == 2
        for k in range(9, len(words), 9):
            words[k] += "."
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["blorgish", "blorgen", "snurfly"])
        if bad:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1, int(toxic)))
    return docs(spark, rows), spark.createDataFrame(labels, LABELS)


def accuracy(report, labels, column):
    rows = report.join(labels, "doc_id").where("held_out").collect()
    return sum(r["predicted"] == r[column] for r in rows) / len(rows), len(rows)


def test_held_out_accuracy(spark):
    rows, labels = labelled_docs(spark)
    right, n = accuracy(toxicity.report(rows, toxicity.train(rows, labels)), labels, "toxic")
    assert n > 40 and right > 0.95
    rules = quality.train(rows, labels)
    right, _ = accuracy(quality.report(rows, rules), labels, "quality")
    assert right > 0.95
    assert 0 < len(rules.weights) < 150 and all(" if " in r for r in rules.described())


def test_sample_is_bounded_and_leaves_held_out_rows(spark):
    rows, labels = labelled_docs(spark)
    some = labelled.training_sample(rows, labels, "toxic", rows=50)
    assert 25 <= some.count() <= 75
    held = {r["doc_id"] for r in rows.where(labelled.held_out()).collect()}
    text = {r["text"] for r in labelled.training_sample(rows, labels, "toxic").collect()}
    assert not text & {r["text"] for r in rows.collect() if r["doc_id"] in held}


def test_offending_sentences_are_located(spark):
    model = toxicity.Model({"moron": 20.0}, -9.0)
    table = docs(spark, [(1, "Fine here. You moron! Fine again."), (2, None), (3, "...")])
    got = {r["doc_id"]: [(s["sentence"], s["text"]) for s in r["offending"]] for r in toxicity.offending(table, model).collect()}
    assert got == {1: [(1, "You moron!")], 2: [], 3: []}
    assert abs(model.score(b"x. moron. y moron") - (1 - np.prod([1 - p for p in 1 / (1 + np.exp([9.0, -11.0, -11.0]))]))) < 1e-9


def test_rules_as_columns(spark):
    rules = quality.Rules({((0, 3.0, True), (9, 0.5, False)): 2.0, ((0, 3.0, False),): -1.0}, 0.5)
    table = docs(spark, [(1, "a b c d e"), (2, "a a a a"), (3, None)])
    got = {r["doc_id"]: r["quality"] for r in quality.score(clashing(table, "statistics"), rules).collect()}
    assert np.allclose([got[1], got[2], got[3]], 1 / (1 + np.exp([-2.5, -0.5, 0.5])))


def test_awkward_rows(spark):
    model, rules = toxicity.Model({"x": 1.0}, -5.0), quality.Rules({((0, 3.0, True),): 2.0}, 0.0)
    for report in (toxicity.report(clashing(awkward(spark), "score"), model), quality.report(clashing(awkward(spark), "score"), rules)):
        rows = report.collect()
        assert len(rows) == awkward(spark).count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.keep_clean(clashing(awkward(spark), "toxicity"), model).columns[-1] == "toxicity"
    assert quality.keep_good(clashing(awkward(spark), "quality"), rules).count() == awkward(spark).count()


def test_without_labels(spark):
    none = spark.createDataFrame([], LABELS)
    only = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 0, 1)], LABELS)
    table = docs(spark, [(1, "a b"), (2, LONG)])
    for labels in (none, only):
        assert toxicity.keep_clean(table, toxicity.train(table, labels)).count() == 2
        assert {r["predicted"] for r in quality.report(table, quality.train(table, labels)).collect()} == {1}
    assert toxicity.report(empty(spark), toxicity.Model()).count() == 0
    assert quality.report(empty(spark), quality.Rules()).count() == 0
