"""Benchmarks whose items follow one template."""

from tiers.llm import decontaminate


def leaked(spark, items, texts):
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect() if r.score == 1}


def test_items_that_differ_in_the_last_or_first_word(spark):
    last = [f"please tell me now what is the capital of country{i}" for i in range(100)]
    first = [f"person{i} was born in which of these years" for i in range(100)]
    items = last + first
    texts = [f"some words before {x} and some more words" for x in items]
    assert leaked(spark, items, texts) == {(i, i) for i in range(200)}


def test_table_of_items(spark):
    items = [f"what is a{i} times b{j}" for i in range(60) for j in range(60)]
    wanted = range(0, 3600, 97)
    found = leaked(spark, items, [f"before it {items[i]} after it" for i in wanted])
    assert found == set(enumerate(wanted))
