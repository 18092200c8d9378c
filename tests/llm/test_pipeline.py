import zlib

import corpus_pipeline
from skyledger.llm import decontam, dedup, jaccard, toxicity
from skyledger.llm import text as tx

SF = "/root/testdata/sf0.001"


def test_stages_against_their_own_inputs(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "n-gram jaccard join", "benchmark decontamination", "mixing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if stage is not corpus_pipeline.mixed:
            assert out.columns == columns
        before, docs = docs.collect(), spark.createDataFrame(out.collect(), out.schema)
        seen.append((stage.__name__, before, docs.collect()))
    by = {n: (b, a) for n, b, a in seen}
    before, after = by["without_copies"]
    norm = lambda t: " ".join(tx.space_words(t)) if False else (t or "")
    import re
    first = {}
    for r in sorted(before, key=lambda r: r["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", norm(r["text"])), r["doc_id"])
    assert sorted(first.values()) == sorted(r["doc_id"] for r in after)
    before, after = by["without_near_copies"]
    sets = {r["doc_id"]: {*map(int, tx.shingle_set(r["text"], tx.WordHash()))} for r in before}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert sorted({*root.values()}) == sorted(r["doc_id"] for r in after)
    before, after = by["without_benchmark"]
    items = [b" ".join(tx.label_words(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in before if not any(i in b" ".join(tx.label_words(r["text"])) for i in items)}
    assert clean == {r["doc_id"] for r in after}
    before, after = by["mixed"]
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before} and all(r["taken"] > 0 for r in after)


def test_run_applies_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "taken"} <= set(out.columns)


def test_stages_take_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_entry_registers_all(spark):
    import __spark_entry__
    names = [*__spark_entry__.queries()]
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
    assert zlib and decontam and dedup and jaccard and toxicity
