import itertools
from collections import Counter

import pytest
from candlemill.llm import filter_audit as a
from candlemill.llm.oracle import ORACLE
from candlemill.llm.queries import QUERIES
from cases import LONG, awkward, clashing, docs, empty
from compare import assert_same, connect
from hypothesis import given, settings
from hypothesis import strategies as st

MANY = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, MANY, "x"), (2, MANY, "x"), (2, MANY, "x"), (3, MANY, "y"), (4, "same " * 80, "x"), (5, "ABC " * 60, "y"), (6, MANY + " #", None),
    (7, None, "x"), (8, "", ""), (9, None, "y"), (None, MANY, "x"), (None, "", "x"), (10, LONG, "y"), (11, "É" * 10, "x"), (-1, "short $", "y"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (4, 1, 1), (6, None, 1), (7, 0, 0), (8, 1, 1), (10, 1, 0), (99, 1, 1), (None, 1, 1)]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def parted(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def brute(rows, known):
    """Runs every order over the documents themselves."""
    found = []
    for i, text, part in rows:
        text = text or ""
        words = [w for w in text.translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w]
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
            fails.add("C")
        if set(text) & set("#$%&*|"):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows):
            fails.add("E")
        good, toxic = (any(k == i and label[n] == 1 for k, *label in known) if i is not None else False for n in (0, 1))
        found.append((part or "", fails, good, toxic))
    out = {}
    for part in {f[0] for f in found}:
        mine = [f for f in found if f[0] == part]
        total = Counter()
        for order in itertools.permutations("ABCDE"):
            here = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in here if f in x[1]]
                here = [x for x in here if f not in x[1]]
                total[f] += len(gone)
                fail = sum(f in x[1] for x in mine)
                alone = sum(x[1] == {f} for x in mine)
                out[part, "".join(order), step] = [len(here), len(gone), fail - len(gone), alone, sum(x[2] for x in gone), sum(x[3] for x in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def as_dict(df):
    rows = df.collect()
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in df.columns[3:]] for r in rows}
    assert len(got) == len(rows)
    return got


def test_against_running_every_order(spark):
    table = clashing(parted(spark), "id", "salt", "part", "bits", "n", "good")
    got = as_dict(a.audit(table, clashing(labels(spark), "id", "salt", "source")))
    assert got == brute(ROWS, LABELS)
    assert len(got) == 3 * 120 * 5
    assert got["x", "ABCDE", 5][0] == 2  # one of the many words, and the row without id


def test_empty_tables(spark):
    assert a.audit(empty(spark), labels(spark)).count() == 0
    rows = as_dict(a.audit(awkward(spark), labels(spark, [])))
    assert len(rows) == 600 and all(r[4] == r[5] == 0 for r in rows.values())


def test_hot_copies_meet_in_few_rows(spark):
    many = spark.range(20_000).selectExpr("id as doc_id", f"if(id % 3 = 0, '{MANY}', concat('{MANY} ', id)) as text", "if(id % 2 = 0, 's', 't') as source")
    got = as_dict(a.audit(many, labels(spark, [])))
    assert got["s", "EABCD", 1][1] + got["t", "EABCD", 1][1] == 6666


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=" \t\n\x0bABab#é ", max_size=40), st.integers(1, 30))
def test_words_in_pieces(text, size):
    data = text.encode()
    assert b"".join(a.pieces(data, size)) == data
    assert [w for p in a.pieces(data, size) for w in p.split()] == data.split()


def test_query_matches_sql(spark, sf_dir):
    assert assert_same(QUERIES["op13_filter_audit"](spark, sf_dir), connect(sf_dir), ORACLE["op13_filter_audit"]) == 20 * 600


@pytest.mark.parametrize(("text", "bits"), [(b"", 1), (b"A", 5), (b"a " * 50, 2), (MANY.encode(), 0), (MANY.encode() + b" |", 8)])
def test_filters(text, bits):
    assert a.failed(text) == bits
