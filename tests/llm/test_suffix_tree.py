import math
import zlib
from collections import Counter

import numpy as np
from cases import awkward, clashing, docs, empty

from candlemill.llm import suffix_tree as t

TEXTS = [b"the cat sat on the mat", b"the cat ate", b"", b"a cat and a hat sat on the cat and the hat"] * 20


def grams(data):
    parts = [t.longest_grams(b"".join(t.stream(t.tokens(x)) for x in part)) for part in (data[::2], data[1::2])]
    return t.all_grams(*t.merged(*parts))


def test_gram_counts_against_brute_force():
    want = Counter()
    for x in TEXTS:
        s = b"\n" + t.stream(t.tokens(x))
        for end in range(1, len(s)):
            for n in range(1, t.DEPTH + 2):
                if end + 1 - n >= 0:
                    want[s[end + 1 - n : end + 1]] += 1
    got = {int(k).to_bytes(n, "big"): int(c) for n, (keys, counts) in enumerate(grams(TEXTS), 1) for k, c in zip(keys, counts, strict=True)}
    assert got == want


def test_state_is_the_longest_retained_suffix():
    tree = t.build(grams(TEXTS), least_share=1e-3, divergence=0.01)
    rng = np.random.default_rng(2)
    data = b"".join(t.stream(t.tokens(bytes(rng.choice(list(b"the cat hat mat"), 700)))) for _ in range(4))
    logs = tree.log10_of(data)
    rows = tree.logs.reshape(-1, 256)
    before = b"\n"
    for symbol, got in zip(data, logs, strict=True):
        context = before[-t.DEPTH :]
        while context not in tree.contexts:
            context = context[1:]
        assert got == rows[tree.contexts[context], symbol]
        before = before + bytes([symbol]) if symbol != 10 else b"\n"
    assert np.allclose((10.0 ** rows.astype(float)).sum(axis=1), 1, atol=1e-4)
    assert len(tree.contexts) > 20


def test_scores_against_brute_force(spark):
    rows = [(i, " ".join(f"w{(i * k) % 37}" for k in range(40))) for i in range(60)]
    table = docs(spark, rows).unionByName(awkward(spark))
    got = t.report(clashing(table, "chunk", "held_out", "score")).collect()
    words = [(r["doc_id"], [*t.tokens((r["text"] or "").encode()), b"\n"]) for r in table.collect()]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in words]
    count = Counter(w for (_, ws), h in zip(words, held, strict=True) if not h for w in ws)
    total = sum(count.values())
    want = sorted(
        (i or -1, h, len(ws), sum(count[w] > 0 for w in ws), total, round(sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in ws), 6))
        for (i, ws), h in zip(words, held, strict=True)
    )
    assert sorted((r["doc_id"] or -1, *r[1:5], round(r["base_score"], 6)) for r in got) == want
    assert all(np.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def test_held_out_texts_score_better_than_the_base(spark, sf_dir):
    rows = t.report(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out").collect()
    assert sum(r["score"] for r in rows) > 0.95 * sum(r["base_score"] for r in rows)


def test_nothing_to_learn_from(spark):
    assert t.report(empty(spark)).count() == 0
    one = t.score(docs(spark, [(1, "a b")]), t.remainder("doc_id", 1) == 0).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in one] == [(3, 0, 0, 0.0)]


def test_score_against_brute_force_over_word_contexts(spark):
    rows = [(i, " ".join(f"w{(i * k) % 11}" for k in range(25))) for i in range(60)]
    table = docs(spark, rows).unionByName(docs(spark, [(70, None), (71, "new words w1 w2"), (72, "w1"), (72, "w1")]))
    held = t.remainder("doc_id", 7) == 2
    got = sorted((r["doc_id"], r["score"]) for r in t.score(table, held, mixed=0.3, context_words=3).collect())
    tree = t.learn_tree(table.where(~held).selectExpr("coalesce(text, '') as text"))
    words = [(r["doc_id"], [*t.tokens((r["text"] or "").encode()), b"\n"]) for r in table.collect()]
    trained = [ws for i, ws in words if zlib.crc32(str(i).encode()) % 7 != 2]
    n = Counter(tuple(ws[i : i + k]) for ws in trained for k in range(1, 5) for i in range(len(ws) - k + 1))
    total = sum(map(len, trained))
    unknown = sum(n[w,] == 1 for w in {w for ws in trained for w in ws}) / (total + 1)
    want = []
    for i, ws in words:
        score = 0.0
        logs = tree.log10_of(t.stream(ws[:-1]))
        begin = 0
        for at, w in enumerate(ws):
            size = len(w) + (w != b"\n")
            spelled = 10 ** logs[begin : begin + size].sum()
            begin += size
            p = (1 - unknown) * (0.3 * n[w,] / total + 0.7 * spelled) if n[w,] else unknown
            for k in range(1, 4):
                context = tuple(ws[at - k : at])
                if at >= k and n[context] >= t.LEAST_SEEN:
                    p = (n[*context, w] + t.WORD_PRIOR * p) / (n[context] + t.WORD_PRIOR)
            score += math.log10(p)
        want.append((i, score))
    assert np.allclose(got, sorted(want), rtol=1e-5)


def test_contexts_of_a_tiny_share_of_the_corpus_are_in_the_tree(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 400, 60)) for _ in range(1000)]
    rows = [(i, x) for i, x in enumerate(texts)] + [(5000 + i, x) for i, x in enumerate(texts[:100])]
    got = {r["doc_id"]: r["score"] for r in t.score(docs(spark, rows), t.remainder("doc_id", 1) == 1).collect()}
    twice, once = [got[i] for i in range(100)], [got[i] for i in range(100, 1000)]
    assert np.mean(twice) > np.mean(once) + 10
    assert np.mean(np.array(twice) > np.max(once)) > 0.5


def test_packed_numbers():
    rng = np.random.default_rng(4)
    for n in ([], [0], [1, 1], [254, 255, 256, 1 << 40, 0, 1], rng.geometric(0.1, 1001)):
        assert t._unpacked_counts(t._packed_counts(np.array(n, np.int64))).tolist() == list(n)
    for values in ([0], [(1 << 64) - 1], [5, 5, 1 << 33], np.sort(rng.integers(0, 1 << 40, 999)).tolist()):
        assert t._unpacked(t._packed(np.array(values, np.uint64)), len(values)).tolist() == values
