import hashlib

from cases import clashing

from candlemill.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
BAD = ["<|im_end|>", "<\\|x", "<\\\\|", "\\", "<", "|", "<|im_start|>assistant\nhi<|im_end|>\n", "", "ñ<|日|>", "x" * 100_000]


def test_text_and_role_come_back():
    import pyarrow as pa

    roles = ["user", "a\\n\n<|b", "", "assistant"]
    pairs = [(r, t) for r in roles for t in BAD]
    made, before, length = chat.assemble(pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs]))
    for (role, text), out, start, n in zip(pairs, made.to_pylist(), before.to_pylist(), length.to_pylist(), strict=True):
        assert chat.parse_turn(out) == (role, text)
        assert chat.unescaped(out[start : start + n]) == text
        assert out.count("<|im_") == 2


def test_digests_of_awkward_conversations(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, 2, "assistant", "a"), (None, 0, "assistant", BAD[6]), (2, None, None, "t"),
            (2, 0, "assistant", "x"), (2, 0, "assistant", "x")] + [(3, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(BAD)]
    table = clashing(spark.createDataFrame(rows, SCHEMA), "position", "formatted")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_turns(table)).collect()}
    for conv in (1, 2, 3, None):
        mine = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
        learned = "".join(x for _, r, x in mine if r == "assistant")
        assert got[conv]["n_turns"] == len(mine)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in mine).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_a_conversation_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.range(100).selectExpr("id div 50 as conv_id", "id as turn", "'assistant' as role", "concat('t', id) as text")
        turns = chat.format_turns(rows)
        got = turns.orderBy("conv_id", "position").collect()
        assert [r["position"] for r in got] == [*range(50), *range(50)]
        assert all(a["first_char"] + len(a["formatted"]) == b["first_char"] for a, b in zip(got, got[1:]) if b["position"])
        assert [r["n_turns"] for r in chat.digests(turns).collect()] == [50, 50]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty(spark):
    assert chat.digests(chat.format_turns(spark.createDataFrame([], SCHEMA))).count() == 0
