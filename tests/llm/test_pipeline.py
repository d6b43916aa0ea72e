"""The pipeline on the smallest tables: every stage does its work and keeps what it should."""

import corpus_pipeline
from fieldloom.llm import decontaminate, ngram_join
from fieldloom.llm.queries import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "decontamination", "mixing", "sharding"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k == 1:
            groups = ngram_join.jaccard_components(docs)
            want = groups.where("n_shingles > 0").select("component_id").distinct().count() + groups.where("n_shingles = 0").count()
            assert out.count() == want
        if k == 2:
            gone = {r.doc_id for r in decontaminate.find_leaks(docs, table(spark, SF, "benchmark")).collect()}
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} - gone
        if k < 4:
            assert out.columns == docs.columns
            docs = out
    assert out.count() == docs.count() and {r.shard for r in out.collect()} <= set(range(16))
