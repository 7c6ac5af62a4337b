"""Rows without an id, and several under one, through the stages that drop documents."""

from tiers.llm import decontaminate, simhash


def text(name):
    return " ".join(f"{name}{i}" for i in range(60))


def rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_one_row_of_each_group_whatever_the_ids(spark):
    a, b, c, d, e = map(text, "abcde")
    docs = spark.createDataFrame([(None, a), (None, b), (None, b), (1, c), (1, d), (2, e), (None, e)], "doc_id long, text string")
    assert rows(simhash.one_of_each(docs)) == sorted([(None, a), (None, b), (1, c), (1, d), (2, e)], key=str)


def test_rows_without_an_id_are_judged_by_their_own_text(spark):
    item, clean = "which city lies on seven hills", text("x")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(None, clean), (None, f"{clean} {item}"), (1, clean), (1, item)], "doc_id long, text string")
    assert rows(decontaminate.clean(docs, benchmark)) == sorted([(None, clean), (1, clean)], key=str)
