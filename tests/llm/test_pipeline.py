"""The registered queries and the pipeline run on whole tables."""

import corpus_pipeline
from tiers.llm.queries import llm_oracles, llm_queries

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    names = list(llm_queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert set(llm_oracles()) <= set(names)


def test_stages_follow_each_other(spark):
    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.schema.simpleString() == first.schema.simpleString()
        docs = corpus_pipeline.keep(after, "test")
    assert 0 < docs.count() < first.count()
    assert docs.where("taken <= 0 or taken > 3 * size").count() == 0
    none = first.where("false")
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF).select(first.columns)
        assert none.count() == 0
