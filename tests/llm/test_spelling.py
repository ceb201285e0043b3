import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from candlemill.llm import spelling as s
from candlemill.llm.queries import QUERIES
from cases import AWKWARD, LONG, awkward, clashing, docs, empty
from hypothesis import given, settings
from hypothesis import strategies as st


def one_edit(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    short, long = sorted((x, y), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def counted(rows, least=7, damaged_of=31):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % damaged_of == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def brute(rows):
    """Compares all words with all."""
    n = counted(rows)
    near = {w: [] for w in n}
    for x, y in itertools.combinations(n, 2):
        if one_edit(x, y):
            near[x].append(y)
            near[y].append(x)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root)
    return out


def got(df):
    rows = df.collect()
    found = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(found) == len(rows)
    return found


def corpus(seed=1):
    rng, rows = random.Random(seed), []
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(7, 10))) for _ in range(40)] + ["ABCDEFGÀÉ", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa"]
    for i in range(400):
        words = []
        for _ in range(rng.randint(0, 25)):
            word = rng.choice(stems[: 1 + int(len(stems) * rng.random() ** 3)])
            if rng.random() < 0.2:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", "b", "x", "ü"]) + word[at + rng.randint(0, 1) :]
            words.append(word)
        rows.append((i, rng.choice([" ", "\n", "9", "日"]).join(words)))
    return [*rows, (1000, "Chainedword " * 500), (1001, "chainedwrd " * 30), (1002, "chaindwrd chaindwrd")]


def test_against_all_pairs(spark):
    rows = corpus()
    want = brute(rows)
    assert got(s.variants(clashing(docs(spark, rows), "word", "n", "id"))) == want
    assert sum(v[2] is not None for v in want.values()) > 20 and any(v[2] and v[2] != v[4] for v in want.values())


def test_split_states_give_the_same(spark):
    """Groups of two words at most: every state with more is split until only edits at one place are left."""
    rows = corpus(2)
    assert got(s.variants(docs(spark, rows), most=2)) == brute(rows)


def test_hot_prefix_and_suffix_are_split(spark):
    words = ["hotstart" + "".join(p) + "hotend" for p in itertools.product("abcd", repeat=5)]
    table = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    groups = s._groups(table, 3, 4, 100)
    sizes = [r["count"] for r in groups.groupBy("side", "at", "exact", "key").count().collect()]
    assert max(sizes) <= 100
    assert {r["n_near"] for r in s.near_words(table, most=100).collect()} == {15}


def test_awkward_rows(spark):
    assert got(s.variants(awkward(spark))) == brute([(i, t) for i, t in AWKWARD])
    assert s.variants(empty(spark)).count() == 0
    assert got(s.variants(docs(spark, [(1, LONG), (1, LONG), (None, None)]))) == {}
    run = "q" * 60_000
    found = got(s.variants(docs(spark, [(1, f"{run} {run}"), (2, f"{run}q {run}q")]), damaged_of=0))
    assert found == {run: (2, 1, None, None, run), run + "q": (2, 1, None, None, run + "q")}


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text(alphabet="abc", max_size=6), max_size=25))
def test_composition_accepts_each_near_pair_once(words):
    words = sorted(words)
    machine = s.Acceptor()
    machine.add(["ac", "b"])  # states are shared between acceptors
    pairs = list(machine.near(machine.add(words), words))
    assert len(pairs) == len(set(map(frozenset, pairs)))
    assert {frozenset(p) for p in pairs} == {frozenset(p) for p in itertools.combinations(words, 2) if one_edit(*p)}


def test_acceptor_is_minimal():
    machine = s.Acceptor()
    root = machine.add(sorted(a + b for a in ("x", "y", "z") for b in ("ing", "ed", "s")))
    reached, left = {root}, [root]
    while left:
        for q in machine.arcs[left.pop()].values():
            if q not in reached:
                reached.add(q)
                left.append(q)
    assert len(reached) == 6  # the start, one after any first letter, in-, ing- and e-, and the end


@pytest.mark.parametrize("name", ["op12_spelling"])
def test_query(spark, sf_dir, name):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = got(QUERIES[name](spark, sf_dir))
    counts = counted(rows)
    assert {w: v[0] for w, v in found.items()} == counts
    some = random.Random(5).sample(sorted(counts), 150)
    for w in some:
        near = [o for o in counts if one_edit(w, o)]
        best = min(near, key=lambda o: (-counts[o], o), default=None)
        assert found[w][1] == len(near)
        assert found[w][2] == (best if best and counts[best] >= 10 * counts[w] else None)
