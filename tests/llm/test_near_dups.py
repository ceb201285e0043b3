import random

import numpy as np
from cases import LONG, awkward, clashing, docs, empty

from candlemill.llm import near_dups as n
from candlemill.llm.graph import components, fingerprint


def words(rng, count):
    return ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(count)]


def changed(rng, base, edits):
    out = list(base)
    for i in rng.sample(range(len(base)), edits):
        out[i] = "edited" + str(rng.random())
    return out


def corpus():
    """Groups of near copies, exact copies, documents that share a passage, and single ones."""
    rng, rows = random.Random(3), []
    passage = words(rng, 60)
    for group in range(12):
        base = words(rng, 200)
        rows += [" ".join(changed(rng, base, k % 4)) for k in range(1 + group % 5)]
        rows += [" ".join(base)] * (group % 3)
    rows += [" ".join(words(rng, 150) + passage + words(rng, 150)) for _ in range(10)]
    hot = words(rng, 120)
    rows += [" ".join(changed(rng, hot, 1 + k % 2)) for k in range(80)]
    rows += ["too short", "too short", "too shorter", "", "!!"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def brute(rows, weights):
    sets = []
    for _, text in rows:
        hashes, counts, _ = n.distinct_shingles([text.encode()])
        sets.append((hashes, weights.of(hashes, counts)))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] == rows[j][1] or n.similarity(sets[i], sets[j]) >= n.SIMILARITY:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def test_classes_against_brute_force(spark):
    rows = corpus()
    table = docs(spark, rows)
    weights = n.frequent_shingles(table.selectExpr("doc_id as id", "text"))
    got = {r["doc_id"]: r["class_id"] for r in n.classes(clashing(table, "id", "hub", "bucket")).collect()}
    assert got == brute(rows, weights)
    assert len(set(got.values())) < len(got) - 80


def test_weights_are_exact(spark, monkeypatch):
    rows = [(i, f"all of the documents begin alike {'and some of them go on so' if i % 4 == 0 else ''} {i} x{i} y{i} z{i}") for i in range(200)]
    table = docs(spark, rows).selectExpr("doc_id as id", "text").repartition(7)
    whole = n.frequent_shingles(table, rare=0.1)
    monkeypatch.setattr(n, "_SUMMARY", 50)
    parts = n.frequent_shingles(table, rare=0.1)
    assert np.array_equal(whole.hashes, parts.hashes) and np.array_equal(whole.values, parts.values)
    hashes, _, _ = n.distinct_shingles([b"all of the documents begin alike"])
    assert np.allclose(parts.of(hashes, np.ones(2)), 1)


def test_agreement_of_samples_is_weighted_jaccard():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    w = rng.uniform(0.5, 3, (2, 300))
    want = np.minimum(*w).sum() / np.maximum(*w).sum()
    order = np.argsort(hashes)
    both = n.band_buckets(np.tile(hashes[order], 2), np.concatenate([w[0][order], w[1][order]]), np.array([300, 300]), bands=1500, rows=1)
    assert abs((both[0] == both[1]).mean() - want) < 0.05


def test_awkward_rows(spark):
    got = {}
    for r in n.classes(clashing(awkward(spark), "class_id", "kept")).collect():
        got.setdefault(r["doc_id"], set()).add((r["class_id"], r["kept"]))
    assert got == {1: {(1, True)}, 2: {(1, False)}, 3: {(3, True)}, 4: {(4, True)}, 5: {(5, True)}, 6: {(5, False)}, 7: {(7, True)}, 8: {(8, True)}, None: {(None, True)}}
    kept = n.keep_one(clashing(awkward(spark), "class", "digest", "digest_"))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 7, 8]
    assert n.classes(empty(spark)).count() == 0
    assert n.keep_one(docs(spark, [(1, LONG), (2, LONG + " end")])).count() == 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100), (200, 90), (90, 300), (300, 200)] + [(500, 500 + k) for k in range(60)] + [(None, 3)]
    rng.shuffle(edges)
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | dict.fromkeys((90, 200, 300), 90) | {500 + k: 500 for k in range(60)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_large_ids(spark):
    top = (1 << 63) - 1
    edges = [(top, top - 1), (top - 1, top - 2), (-top, -top + 1), (None, top), (-top, None)]
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {top: top - 2, top - 1: top - 2, top - 2: top - 2, -top: -top, -top + 1: -top}


def test_fingerprint_of_many_edges(spark):
    edges = spark.range(20_000_000).selectExpr("id + 1 as u", "id as v")
    assert fingerprint(edges) == fingerprint(edges.repartition(3)) != fingerprint(edges.where("u <> 5"))


def test_shared_ids_lose_no_text(spark):
    rng = random.Random(8)
    one, two, three = (words(rng, 60) for _ in range(3))
    near = [" ".join(changed(rng, base, 1)) for base in (one, two)]
    rows = [(1, " ".join(one)), (1, " ".join(two)), (1, " ".join(two)), (0, near[0]), (5, near[1]), (7, " ".join(three))]
    got = sorted({(r["doc_id"], r["class_id"], r["kept"]) for r in n.classes(docs(spark, rows)).collect()})
    assert got == [(0, 0, True), (1, 0, False), (1, 1, True), (5, 1, False), (7, 7, True)]
    kept = [(r["doc_id"], r["text"]) for r in n.keep_one(docs(spark, rows)).collect()]
    assert sorted(kept) == sorted([(0, near[0]), (1, " ".join(two)), (7, " ".join(three))])


def sharing(count, share=74, seed=5):
    """Texts that share a passage of `share` of their 100 words and nothing else."""
    rng = random.Random(seed)
    passage = words(rng, share)
    return [(i, " ".join(passage + words(rng, 100 - share))) for i in range(count)]


def test_a_shared_passage_makes_no_pairs(spark, monkeypatch):
    rows, seen = {}, n.written
    for count in (300, 1200):

        def spied(df, label, count=count):
            out = seen(df, label)
            rows[label, count] = rows.get((label, count), 0) + out.count()
            return out

        monkeypatch.setattr(n, "written", spied)
        found = n.classes(docs(spark, sharing(count)))
        assert found.select("class_id").distinct().count() == count
        # Each text is checked against a bounded number of others, whatever their number.
        assert rows["stray-pairs", count] + rows["middle-pairs", count] + rows["pairs", count] <= 40 * count
        assert rows.get(("prefixes", count), 0) <= 40 * count
    assert rows["open-texts", 1200] > 100


def test_prefix_filter_loses_no_pair():
    """Any two similar weighted sets share a shingle that the filter lets pass."""
    rng = np.random.default_rng(4)
    universe = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    common = {h: c for h, c in zip(universe, rng.integers(0, 5, 60), strict=True)}
    sets = []
    for _ in range(150):
        base = universe[:40] if rng.random() < 0.8 else universe
        chosen = np.sort(rng.choice(base, rng.integers(len(base) - 8, len(base) + 1), replace=False))
        sets.append((chosen, np.where(rng.random(len(chosen)) < 0.05, 2, 1) * 1.25))
    least, found = 0.8, []
    for h, w in sets:
        places, before, held, sizes = n.prefixes(h, w, np.array([len(h)]), np.array([common[x] for x in h]), least)
        found.append((float(sizes[0]), {h[p]: (b, k) for p, b, k in zip(places, before, held, strict=True)}))
    similar = passed = 0
    for i in range(len(sets)):
        for j in range(i):
            (size_a, a), (size_b, b) = found[i], found[j]
            small, large = ((a, b) if size_a <= size_b else (b, a))
            lets = any(
                x in large and (small[x][1] or (size_a == size_b and large[x][1]))
                and min(size_a - a[x][0], size_b - b[x][0]) >= (1 - 1e-9) * least / (1 + least) * (size_a + size_b)
                for x in small
            )
            passed += lets
            if n.similarity(sets[i], sets[j]) >= least:
                similar += 1
                assert lets
    assert similar > 100 and passed < 150 * 149 / 2


def test_components_of_known_classes_take_few_queries(spark, monkeypatch):
    from candlemill.llm import graph

    written, tables = graph.written, []
    monkeypatch.setattr(graph, "written", lambda df, label: tables.append(label) or written(df, label))
    monkeypatch.setattr(graph, "fingerprint", lambda edges: tables.append("asked") or fingerprint(edges))
    stars = spark.range(100).selectExpr("id as a", "id - id % 10 as b")
    assert {tuple(r) for r in components(stars).collect()} == {(i, i - i % 10) for i in range(100)}
    assert tables == ["edges", "edges"]  # what is written says itself whether it changed
    tables.clear()
    assert components(stars.where("a < 0")).count() == 0 and tables == ["edges"]
