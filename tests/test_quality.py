from datetime import datetime

from pyspark.sql import functions as F

from tiers.operators.quality import (
    date_order,
    latest_per_key,
    positive_durations,
    rejects,
    required_ok,
    row_id,
)
from tiers.functions.dates import day_counts
from tiers.plans.adhoc import one_fertilizer_each
from tiers.plans.silver import clean_rows, rejected_rows
from tiers.specs import AVOCADO, CONSUMER, FERTILIZER

OLD, NEW = datetime(2024, 1, 1), datetime(2024, 1, 2)


def bronze(spark, spec, rows):
    """Rows as dicts of the columns that matter; the rest is NULL."""
    fields = spec.bronze_schema.names
    return spark.createDataFrame(
        [tuple({"raw_file_name": "f.csv", "load_timestamp": OLD, **row}.get(f) for f in fields) for row in rows],
        spec.bronze_schema,
    )


def test_latest_row_wins_and_ties_are_decided(spark):
    df = bronze(
        spark,
        CONSUMER,
        [
            {"consumerid": "a", "sex": "F", "load_timestamp": OLD},
            {"consumerid": "a", "sex": "M", "load_timestamp": NEW},
            {"consumerid": "b", "sex": None, "age": "1"},
            {"consumerid": "b", "sex": "M", "age": "2"},
            {"consumerid": "b", "sex": "M", "age": "1"},
            {"consumerid": "c", "sex": "F", "load_timestamp": None},
            {"consumerid": "c", "sex": "M", "load_timestamp": OLD},
        ],
    )
    for parts in (1, 5):
        rows = latest_per_key(df.repartition(parts), ["consumerid"], CONSUMER.tie_breakers).collect()
        assert {(r["consumerid"], r["sex"], r["age"]) for r in rows} == {
            ("a", "M", None),
            ("b", "M", "1"),
            ("c", "M", None),
        }


def test_files_decide_between_equal_rows(spark):
    rows = [{"consumerid": "a", "raw_file_name": name} for name in ("2.csv", "1.csv", "3.csv")]
    kept = latest_per_key(bronze(spark, CONSUMER, rows), ["consumerid"], CONSUMER.tie_breakers)
    assert [r["raw_file_name"] for r in kept.collect()] == ["1.csv"]


def test_invalid_latest_row_removes_the_key(spark):
    df = bronze(
        spark,
        AVOCADO,
        [
            {"purchaseid": "1", "consumerid": "x", "load_timestamp": OLD},
            {"purchaseid": "1", "consumerid": None, "load_timestamp": NEW},
            {"purchaseid": "2", "consumerid": "y"},
            {"purchaseid": "two", "consumerid": "y"},
            {"purchaseid": None, "consumerid": "z"},
        ],
    )
    assert [r["purchaseid"] for r in clean_rows(df, AVOCADO).collect()] == [2]
    bad = rejected_rows(df, AVOCADO)
    assert {(r["purchaseid_raw"], r["error_reason"]) for r in bad.collect()} == {
        ("1", "missing or unreadable: consumerid"),
        ("two", "missing or unreadable: purchaseid"),
        (None, "missing or unreadable: purchaseid"),
    }


def test_one_key_written_in_two_ways_is_one_key(spark):
    df = bronze(
        spark,
        AVOCADO,
        [
            {"purchaseid": " 7 ", "consumerid": "x", "load_timestamp": NEW},
            {"purchaseid": "7.0", "consumerid": "x", "load_timestamp": OLD},
        ],
    )
    rows = clean_rows(df, AVOCADO).collect()
    assert [(r["purchaseid"], r["load_timestamp"]) for r in rows] == [(7, NEW)]


def test_rejects_complement_the_required_filter(spark):
    df = bronze(
        spark,
        FERTILIZER,
        [
            {"purchaseid": p, "consumerid": c, "fertilizerid": f}
            for p in ("1", None)
            for c in ("x", None)
            for f in ("9", None)
        ],
    )
    good, bad = required_ok(df, FERTILIZER.required), rejects(df, FERTILIZER.required)
    assert (good.count(), bad.count()) == (1, 7)
    reasons = {r["error_reason"] for r in bad.filter("purchaseid is null and consumerid is null").collect()}
    assert reasons == {
        "missing or unreadable: purchaseid, consumerid",
        "missing or unreadable: purchaseid, consumerid, fertilizerid",
    }


def test_row_id_tells_null_from_empty_and_shifted_values(spark):
    df = spark.createDataFrame(
        [("a", None), (None, "a"), ("a", ""), ("", "a"), ("a,", "b"), ("a", ",b")], "x string, y string"
    )
    ids = [r[0] for r in df.select(row_id(["x", "y"])).collect()]
    assert len(set(ids)) == 6


def test_fertilizers_without_id_count_as_one(spark):
    df = bronze(
        spark,
        FERTILIZER,
        [
            {"fertilizerid": None, "type": "b"},
            {"fertilizerid": None, "type": "a"},
            {"fertilizerid": "1", "type": "z"},
            {"fertilizerid": "one", "type": "y"},
        ],
    ).drop("raw_file_name", "load_timestamp")
    assert {r["type"] for r in one_fertilizer_each(df).collect()} == {"a", "z", "y"}


def test_date_rules_differ(spark):
    days = [
        (1, "2024-01-01", "2024-01-03", "2024-01-05"),
        (2, "2024-01-03", "2024-01-01", "2024-01-05"),
        (3, "2024-01-01", "2024-01-01", "2024-01-05"),
        (4, "2024-01-01", "2024-01-05", "2024-01-05"),
        (5, None, "2024-01-03", "2024-01-05"),
    ]
    df = spark.createDataFrame(days, "id int, born_date string, picked_date string, sold_date string")
    df = df.select("id", *[F.col(c).cast("date").alias(c) for c in df.columns[1:]], F.lit(1).alias("ripe_index_when_picked"))
    counted = day_counts(df)
    assert [tuple(r) for r in counted.filter("id < 3").select("avocado_days_sold", "avocado_days_picked").collect()] == [
        (4, 2),
        (2, 4),
    ]
    assert [r["id"] for r in date_order(df).collect()] == [1]
    assert [r["id"] for r in positive_durations(counted).collect()] == [1, 2, 3]


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = bronze(spark, AVOCADO, [{"purchaseid": "1", "consumerid": "x"}])
    plan = clean_rows(df, AVOCADO)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange") == 1
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert "Python" not in plan
