"""Tables that Spark sizes too low, after an explode or by files of repeating values, are not sent through the driver."""

from tiers.llm import simhash


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_links_and_groups_are_joined_by_shuffles(spark):
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join(words[: 30 + i % 5])) for i in range(20)], "doc_id long, text string")
    fps = spark.range(1000).selectExpr("xxhash64(id) fp")
    assert "BroadcastExchange" not in plan(simhash.links(fps))
    found = simhash.near_duplicates(docs)
    assert "BroadcastExchange" not in plan(found)
    assert found.count() == 20 and {r.doc_id for r in found.where("component_id > doc_id").collect()} == set()
    assert "BroadcastExchange" not in plan(simhash.one_of_each(docs.union(docs)))
