import __spark_entry__ as entry
import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from candlemill.llm import decontaminate, near_dups, quality, toxicity
from candlemill.llm.queries import QUERIES, VOCABULARY


def test_registered():
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)


def test_pipeline_is_its_operators_in_order(spark, sf_dir):
    """Each stage keeps what its operator's report keeps, and the last one encodes as the library does."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    columns = docs.columns
    found = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        ids = {r["doc_id"] for r in docs.collect()}
        if name == "toxicity":
            keep = toxicity.report(docs, toxicity.train(docs, labels)).where("predicted = 0")
        elif name == "quality":
            keep = quality.report(docs, quality.train(docs, labels)).where("predicted = 1")
        elif name == "near-dedup":
            keep = near_dups.classes(docs).where("kept")
        else:
            bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
            keep = decontaminate.report(decontaminate.find_leaks(docs, bench)).where("not contaminated")
        want = {r["doc_id"] for r in keep.collect()}
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        found[name] = {r["doc_id"] for r in docs.collect()}
        assert found[name] == want and found[name] < ids
    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    want = {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, sf_dir).collect()} == want
