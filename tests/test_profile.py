import math

import pytest
from pyspark.sql import functions as F

from tiers.operators.profile import (
    full_row_duplicates,
    key_duplicates,
    missing_counts,
    profile,
    profile_report,
    repeats,
    row_count,
)


@pytest.fixture(scope="module")
def people(spark):
    data = [("190", "x", 1.5), ("36", "NaN", 2.5), (None, "1e3", float("nan")), ("36", "o'x\\y", None), ("36", "NaN", 2.5)]
    return spark.createDataFrame(data, "age string, `odd ``'name` string, score double")


def test_counts(people):
    assert row_count(people).first()[0] == 5
    assert missing_counts(people).first().asDict() == {"row_count": 5, "age": 1, "odd `'name": 2, "score": 2}


def test_profile_of_text_and_numbers(people):
    by_name = {r["column_name"]: r for r in profile(people).collect()}
    age = by_name["age"]
    assert (age["data_type"], age["row_count"], age["filled"], age["missing"]) == ("string", 5, 4, 1)
    assert (age["text_min"], age["text_max"]) == ("190", "36")
    assert (age["number_min"], age["number_max"]) == (36.0, 190.0)
    assert age["mean"] == pytest.approx(74.5) and age["stddev"] == pytest.approx(77.0)
    odd = by_name["odd `'name"]
    assert (odd["text_min"], odd["text_max"]) == ("1e3", "x")
    assert odd["number_min"] == 1000.0 and math.isnan(odd["mean"])
    assert by_name["score"]["data_type"] == "double" and by_name["score"]["text_min"] is None


@pytest.mark.parametrize(
    "text,number",
    [(" 12 ", 12.0), ("-1.5e2", -150.0), (".5", 0.5), ("5.", 5.0), ("Infinity", math.inf), ("-inf", -math.inf),
     ("2024-01-05", None), ("5mg", None), ("info", None), ("", None), ("1 2", None)],
)
def test_numbers_in_text(spark, text, number):
    df = spark.createDataFrame([(text,)], "c string")
    assert profile(df).first()["number_min"] == number


def test_profile_of_other_types(spark):
    df = spark.sql("select date'2024-01-01' d, true b, cast(1.5 as decimal(5,2)) m, array(1) a")
    got = {r["column_name"]: r for r in profile(df).collect()}
    assert got["d"]["filled"] == got["b"]["filled"] == got["a"]["filled"] == 1
    assert got["m"]["mean"] == 1.5 and got["d"]["mean"] is None


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert [(r["row_count"], r["filled"], r["mean"]) for r in profile(df).collect()] == [(0, 0, None)] * 2
    assert full_row_duplicates(df).first()[0] == 0


def test_duplicates(people):
    assert full_row_duplicates(people).first()[0] == 1
    assert {tuple(r) for r in key_duplicates(people, ["age"]).collect()} == {("36", 3)}


def test_null_keys_repeat_too(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    assert [tuple(r) for r in key_duplicates(df, ["k"]).collect()] == [(None, 2)]


def test_report(people):
    rows = {(r["column_name"], r["figure"]): r["value"] for r in profile_report(people, ["age"]).collect()}
    assert rows["*", "row_count"] == "5" and rows["*", "duplicate_rows"] == "1" and rows["*", "duplicate_keys"] == "1"
    assert rows["age", "missing"] == "1" and rows["score", "data_type"] == "double"


def test_profile_scans_once_and_moves_one_row_per_task(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id as string) as a", "id as b").write.parquet(str(tmp_path / "t"))
    plan = profile(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange SinglePartition") == plan.count("Exchange") == 1


def test_rows_that_only_share_a_hash_are_no_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None), (3, None), (4, "a")], "k int, v string")

    def same_for_all(_):
        return [F.lit(1), F.lit(2)]

    assert full_row_duplicates(df, key=same_for_all).first()[0] == 2
    assert full_row_duplicates(df).first()[0] == 2
    assert repeats(df, ["k"]).first().asDict() == {"row_count": 6, "duplicate_rows": 2, "duplicate_keys": 2}


def test_content_keys_tell_rows_apart_as_grouping_does(spark):
    nan = float("nan")
    data = [(None, "a", 0.0), ("a", None, 0.0), ("a", None, -0.0), ("a", "", nan), ("a", "", nan), ("", "a", 1.0), (None, None, None)]
    df = spark.createDataFrame(data, "a string, b string, c double")
    wanted = len(data) - df.distinct().count()
    assert full_row_duplicates(df).first()[0] == wanted == 2
    assert repeats(df, ["a"]).first()["duplicate_rows"] == wanted
    wide = spark.createDataFrame([([1], {"x": 1}["x"], ("p", 2))] * 2, "a array<int>, b int, s struct<p string, q int>")
    assert full_row_duplicates(wide).first()[0] == 1


def test_whole_rows_are_not_the_key_of_the_main_shuffle(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id as string) as a", "id as b").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    plan = full_row_duplicates(rows)._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("_content_1" in k for k in keys) and len([k for k in keys if "_content_1" not in k]) == 1
    # The comparison of whole rows is above the join that leaves only rows with a repeated key.
    assert plan.index("hashpartitioning(a#") < plan.index("LeftSemi") < plan.index("hashpartitioning(_content_1")


def test_the_report_takes_one_scan(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id % 900 as string) as a", "id % 900 as b").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    plan = repeats(rows, ["b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    report = profile_report(rows, ["b"])
    after = report._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in after  # what the one job found is in the report
    found = {(r["column_name"], r["figure"]): r["value"] for r in report.collect()}
    assert found["*", "row_count"] == "1000" and found["*", "duplicate_rows"] == "100" and found["*", "duplicate_keys"] == "100"
    assert found["a", "number_max"] == "899.000000" and found["b", "missing"] == "0"


def test_a_report_of_nothing(spark):
    found = profile_report(spark.createDataFrame([], "a string, b int"), ["b"]).collect()
    assert {(r["column_name"], r["figure"]): r["value"] for r in found}["*", "row_count"] == "0"
    assert len(found) == 2 * 9 + 3
