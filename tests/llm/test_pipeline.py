"""The stages one after another: what each keeps, against brute force; odd rows; an empty table."""

from collections import Counter

import corpus_pipeline
from tests.llm.cases import edge_docs, edge_rows, empty_docs, save
from tests.llm.test_free import near_by_hand, shingle_set
from tests.llm.test_native import lines_by_hand, metrics

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_duplicates", "mixing", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.written(stage(spark, before, SF), f"test-{name}")
        if name != "packing":
            assert after.columns == docs.columns
        old, new = before.collect(), after.collect()
        if name == "quality":
            good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r["quality"] == 1}
            gone = [r for r in old if r["doc_id"] not in {x["doc_id"] for x in new}]
            assert gone
            for r in gone:
                m = metrics(r["text"])
                assert r["doc_id"] not in good or m[0] < 20 or 100 * m[4] > 30 * m[0]
        if name == "lines":
            want = {d: n for d, _, n, _ in lines_by_hand([(r["doc_id"], r["text"]) for r in old])}
            assert {r["doc_id"]: r["text"].count("\n") for r in new} == {r["doc_id"]: max(0, r["text"].count("\n") - want[r["doc_id"]]) for r in old}
        if name == "near_duplicates":
            kept = {d for d, (_, _, k) in near_by_hand([(r["doc_id"], r["text"]) for r in old]).items() if k}
            assert {r["doc_id"] for r in new} == kept
        if name == "mixing":
            n = Counter(r["doc_id"] for r in new)
            assert set(n) <= {r["doc_id"] for r in old} and max(n.values()) <= 3
        if name == "packing":
            docs_in = Counter(r["doc_id"] for r in old)
            assert Counter(r["doc_id"] for r in new if r["piece"] == 0) == docs_in
        before = after
    assert corpus_pipeline.run(spark, SF).count() == before.count()
    assert shingle_set("a b") == {("a", "b")}


def test_odd_and_empty(spark, tmp_path):
    out = corpus_pipeline.run(spark, save(edge_docs(spark), tmp_path))
    assert {r["doc_id"] for r in out.collect()} <= {r[0] for r in edge_rows()}
    assert corpus_pipeline.run(spark, save(empty_docs(spark), tmp_path / "none")).count() == 0
