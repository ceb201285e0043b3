import __spark_entry__ as entry
import pytest
from cases import LONG, awkward, clashing, docs, empty
from compare import assert_same, connect

from candlemill.llm import decontaminate as d

ITEM = "one two three four five six seven eight nine ten eleven twelve"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute(text, rows, window=10):
    words, hit, found = d.words((text or "").encode()), set(), set()
    for item, t in rows:
        w = d.words((t or "").encode())
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for k in range(len(words) - n + 1):
                if words[k : k + n] == w[i : i + n]:
                    hit.update(range(k, k + n))
                    found.add("null" if item is None else str(item))
    return len(words), len(hit), len(found), d.digest(list(found)), bool(hit)


def test_against_brute_force(spark):
    bench = [(1, ITEM), (10, ITEM.upper()), (2, "Short item"), (3, ""), (4, None), (None, "wizards make toxic")]
    rows = [
        (20, "x " + ITEM + " y"), (21, "zero " + " ".join(ITEM.split()[:9])), (22, "a short  ITEM, twice: short item"),
        (23, ITEM.replace(" ", "; ") + " one"), (24, "short\nitem"), (25, LONG + " " + ITEM),
    ]
    table = docs(spark, rows).unionByName(awkward(spark))
    got = d.report(d.find_leaks(clashing(table, "leak", "n_words"), items(spark, bench))).collect()
    want = [(r["doc_id"], *brute(r["text"], bench)) for r in table.collect() if r["text"] != LONG]
    assert sorted(map(str, (tuple(r) for r in got if r["doc_id"] != 4))) == sorted(map(str, want))


def test_large_benchmarks_give_the_same(spark, monkeypatch):
    """Shared, short and NULL items, windows of many items and documents, copies, awkward and long texts."""
    bench = items(spark, [*((i, f"{ITEM} {i}") for i in range(30)), (31, "Short item"), (32, None), (None, "wizards make toxic"), (33, ITEM)])
    rows = [*((i, f"start {ITEM} {i} end") for i in range(0, 40, 3)), *((100 + i, f"short ITEM; {ITEM}") for i in range(20))]
    table = clashing(docs(spark, [*rows, (200, f"{LONG} {ITEM}")]).unionByName(awkward(spark)), "leak", "leak_digest", "salt")
    whole = d.find_leaks(table, bench)
    want = sorted(map(str, whole.select("doc_id", "leak").collect()))
    monkeypatch.setattr(d, "BLOCK_BYTES", 100)
    got = d.find_leaks(table, bench)
    assert got.columns == whole.columns
    assert sorted(map(str, got.select("doc_id", "leak").collect())) == want
    kept = sorted(r["doc_id"] or -1 for r in d.remove_leaks(table, bench).collect())
    monkeypatch.undo()
    assert kept == sorted(r["doc_id"] or -1 for r in d.remove_leaks(table, bench).collect())


def test_false_hashes_are_no_hits(spark, monkeypatch):
    """A hash set that holds everything sends all windows on; only those of equal words count."""
    table = docs(spark, [(1, ITEM + " tail"), (2, "some clean words, no fewer than ten of them stand here")])
    monkeypatch.setattr(d, "BLOCK_BYTES", 0)
    monkeypatch.setattr(d, "_hash_set", lambda windows: d.np.full(d.SLOTS // 8, 255, d.np.uint8))
    got = d.report(d.find_leaks(table, items(spark, [(1, ITEM)]))).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in got] == [(13, 12, 1, True), (11, 0, 0, False)]


def test_removal(spark):
    bench = items(spark, [(1, ITEM)])
    table = clashing(docs(spark, [(1, f"Before, {ITEM}! After."), (2, "clean text"), (3, None)]), "leak", "n_words")
    assert [r["doc_id"] for r in d.remove_leaks(table, bench).orderBy("doc_id").collect()] == [2, 3]
    cut = d.remove_leaks(table, bench, spans_only=True)
    assert cut.columns == table.columns
    assert [r["text"] for r in cut.orderBy("doc_id").collect()] == ["Before, ! After.", "clean text", None]


@pytest.mark.parametrize("bytes_", [d.BLOCK_BYTES, -1])
def test_empty_tables(spark, monkeypatch, bytes_):
    monkeypatch.setattr(d, "BLOCK_BYTES", bytes_)
    none = items(spark, [])
    assert d.report(d.find_leaks(empty(spark), none)).count() == 0
    assert not d.report(d.find_leaks(awkward(spark), none)).where("contaminated").count()


@pytest.mark.parametrize("name", ["op5_decontaminate", "op10_chat", "op4_licenses"])
def test_queries_match_sql(spark, sf_dir, name):
    assert assert_same(entry.queries()[name](spark, sf_dir), connect(sf_dir), entry.oracle_sql()[name]) > 0
