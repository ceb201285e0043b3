import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from candlemill.llm import language_id as l
from candlemill.llm.queries import QUERIES
from cases import LONG, awkward, clashing, docs, empty

B, E = "\x02", "\x03"


def longest(words, order=l.ORDER):
    grams = Counter()
    for word in words:
        symbols = B + word + E
        for end in range(2, len(symbols) + 1):
            grams[symbols[max(0, end - order) : end]] += 1
    return grams


class Plain:
    """Interpolated Kneser-Ney by its formula, with dictionaries."""

    def __init__(self, words, order=l.ORDER):
        self.order, full = order, longest(words, order)
        self.counts = [None] * (order + 1)
        for k in range(order, 0, -1):
            here = Counter({g: n for g, n in full.items() if len(g) == k})
            if k < order:
                for g in self.counts[k + 1]:
                    here[g[1:]] += 1
            self.counts[k] = here
        self.cut = [0.0] * (order + 1)
        self.after = [defaultdict(list) for _ in range(order + 1)]
        for k in range(1, order + 1):
            values = list(self.counts[k].values())
            once, twice = values.count(1), values.count(2)
            self.cut[k] = once / (once + 2 * twice) if once and twice else 0.5
            for g, n in self.counts[k].items():
                self.after[k][g[:-1]].append(n)
        self.symbols = len(self.counts[1])

    def p(self, context, symbol):
        lower = self.p(context[1:], symbol) if context else 1 / (self.symbols + 1)
        k = len(context) + 1
        seen = self.after[k].get(context)
        if not seen:
            return lower
        cut, total = self.cut[k], sum(seen)
        return max(self.counts[k].get(context + symbol, 0) - cut, 0) / total + sum(min(cut, n) for n in seen) / total * lower

    def log(self, word):
        symbols = B + word + E
        return sum(math.log(self.p(symbols[max(0, i - self.order + 1) : i], symbols[i])) for i in range(1, len(symbols)))


def some_words(seed, letters, n=3000):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(n)]


def model(words):
    grams = longest(words)
    return l.Model(list(grams), np.array(list(grams.values())))


def test_model_is_interpolated_kneser_ney():
    words = some_words(1, "aabcdeé") + ["hello", "help", "日本"] * 5
    plain, fast = Plain(words), model(words)
    tried = [*words[:200], "hello", "helb", "xyzzy", "日本日", "a", "x", "b" * 300]
    assert np.allclose(l.word_logs([fast], tried)[:, 0], [plain.log(w) for w in tried], rtol=2e-5, atol=1e-4)


def test_probabilities_add_up_to_one():
    plain = Plain(some_words(2, "abcd"))
    for context in ("", B, "a", "ab", B + "ab", "abcd", "zz"):
        total = sum(plain.p(context, c) for c in [*"abcd", E]) + plain.p(context, "unknown")
        assert abs(total - 1) < 1e-9


def corpus(n=600):
    rng, rows = random.Random(4), []
    words = {"aa": some_words(1, "aaabcd"), "bb": some_words(2, "bbbacd"), "cc": some_words(3, "cccabd")}
    for i in range(n):
        lang = "aabbcc"[2 * (i % 3) : 2 * (i % 3) + 2]
        rows.append((i, " ".join(rng.choices(words[lang], k=rng.randint(3, 60))), lang if i % 7 else None))
    return rows


def as_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_scores_against_the_formula(spark):
    rows = corpus()
    table = as_table(spark, rows).repartition(5)
    found = l.train(table)
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _, _ in rows}
    plain = {g: Plain([w for i, t, lang in rows if lang == g and fold[i] > 1 for w in t.split()]) for g in ("aa", "bb", "cc")}
    out = {r["doc_id"]: r for r in l.identify(clashing(table, "score", "id"), found).collect()}
    wrong = 0
    for i, text, _ in rows[:120]:
        words = text.split()
        symbols = sum(map(len, words)) + len(words)
        entropies = {g: -sum(map(m.log, words)) / symbols for g, m in plain.items()}
        best = min(entropies, key=entropies.get)
        assert abs(out[i]["entropy"] - entropies[best]) < 1e-4 and out[i]["held_out"] == (fold[i] == 0)
        wrong += out[i]["lang_pred"] != best
    assert wrong == 0
    assert all(0.5 <= r["score"] <= 1 for r in out.values())


def test_held_out_labels_teach_nothing(spark):
    rows = corpus()
    changed = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else g) for i, t, g in rows]
    first, second = (l.train(as_table(spark, r)) for r in (rows, changed))
    assert first.languages == second.languages == ["aa", "bb", "cc"]
    assert all(np.array_equal(a.logs, b.logs) for a, b in zip(first.models, second.models, strict=True))


def test_rejection(spark, monkeypatch):
    monkeypatch.setattr(l, "REJECTED", 0.02)
    rows = corpus(3000)
    found = l.train(as_table(spark, rows))
    strange = [(-i, " ".join(some_words(i, "wxyz", 40)), None) for i in range(1, 40)]
    out = l.identify(as_table(spark, rows + strange), found).collect()
    known = [r["rejected"] for r in out if r["doc_id"] >= 0]
    assert sum(known) / len(known) < 0.06
    assert all(r["rejected"] and r["lang_pred"] in found.languages for r in out if r["doc_id"] < 0)
    kept = l.keep_language(clashing(as_table(spark, rows + strange), "kept_id"), found, ["aa"]).collect()
    assert 900 < len(kept) < 1100 and all(r["kept_id"] == "kept" for r in kept)
    assert sum(r["doc_id"] % 3 == 0 for r in kept) > 0.98 * len(kept)


def test_score_is_calibrated():
    rng = np.random.default_rng(0)
    lead, symbols = rng.exponential(0.1, 20_000), rng.integers(5, 200, 20_000)
    right = rng.random(20_000) < 1 / (1 + np.exp(-0.7 * lead * np.sqrt(symbols)))
    found = l.Identifier(["a", "b"], [])
    found.calibrate(np.zeros(20_000, int), lead, lead, symbols, right)
    assert abs(found.steepness - 0.7) < 0.05


def test_awkward_rows(spark):
    found = l.train(clashing(awkward(spark), "calibrates", "place", "n"))
    assert found.languages == ["en"]
    out = {r["doc_id"]: r for r in l.identify(clashing(awkward(spark), "entropy"), found).collect()}
    assert {i: r["lang_pred"] for i, r in out.items()} == {i: "und" if i in (1, 2, 3, 8) else "en" for i in out}
    assert all(out[i]["score"] == 0 and out[i]["entropy"] is None and out[i]["rejected"] for i in (1, 2, 3, 8))
    nothing = l.train(empty(spark))
    assert nothing.languages == [] and l.identify(empty(spark), nothing).count() == 0
    assert {r["lang_pred"] for r in l.identify(docs(spark, [(1, "abc"), (2, LONG), (2, None)]), nothing).collect()} == {"und"}


def test_long_texts_in_pieces(monkeypatch):
    words = some_words(5, "abcde", 4000)
    scorer = l._Scorer([model(words[:2000])])
    whole, n = scorer.entropies([" ".join(words).encode()])
    monkeypatch.setattr(l, "pieces", lambda text: [p for p in text.replace(b" ", b" |").split(b"|")])
    parts, m = l._Scorer(scorer.models).entropies([" ".join(words).encode()])
    assert n == m and np.allclose(whole, parts)


def test_accuracy_on_held_out_documents(spark, sf_dir):
    out = QUERIES["op11_language"](spark, sf_dir)
    langs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = out.where("held_out").join(langs, "doc_id").collect()
    assert len(rows) > 20 and sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)
