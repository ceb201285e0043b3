import json
import random

import public_tokenizers
import pytest
from cases import awkward, clashing, docs, empty, sha
from tokenizers import Tokenizer

from candlemill.llm import bpe
from candlemill.llm.queries import VOCABULARY

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH) as file:
        return bpe.Bpe(json.load(file))


def texts():
    rng = random.Random(5)
    yield from ["", " ", "it's we'll 12 x9y", "ΑΣ Σ İstanbul ﬁ Å", "<|endoftext|>hi<|startoftext|>", "日本語 😀 é"]
    yield from ("".join(rng.choice("aenot ") for _ in range(200)) for _ in range(60))
    yield from ("".join(rng.choice("abcdefghijklmnop") for _ in range(n)) for n in (2, 63, 64, 65, 66, 3000))
    yield "a" * 5000
    yield " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzáéñ") for _ in range(rng.randint(1, 15))) for _ in range(3000))


def test_same_as_library(own, library):
    cases = list(texts())
    for text, (n, ids, decoded) in zip(cases, own.encode_texts(cases), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)) and n == len(want), text[:80]
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_most_words_need_the_check(own):
    words = [w for t in texts() for w in own.pattern.findall(own.normal(t))]
    mapped = ["".join(own.symbols[b] for b in w.encode()) for w in words]
    wrong = [w for w in mapped if own.greedy(w) != own.exact([w])[0]]
    assert wrong and len(wrong) < len(mapped)


def test_digests(spark, library):
    rows = clashing(awkward(spark), "n_tokens", "made")
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(rows, PATH).collect())
    want = []
    for r in awkward(spark).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"] or -1, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want)


def test_round_trip_and_empty(spark):
    made = bpe.decode(bpe.encode(docs(spark, [(1, "low lower"), (2, None)]), PATH).select("doc_id", "encoded.ids"), PATH)
    assert [r["decoded"] for r in made.orderBy("doc_id").collect()] == ["low</w> lower</w>", ""]
    assert bpe.digests(empty(spark), PATH).count() == 0
