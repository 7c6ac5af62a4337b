import random
from collections import Counter

import pytest

from tiers.operators.joins import hot_keys, key_rows, plain_join, spread_join


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def frame(spark, data, schema, parts=4):
    return spark.createDataFrame(data, schema).repartition(parts)


@pytest.fixture(scope="module")
def skewed(spark):
    """Keys 'hot' (both sides), 'left' and 'right' (one side only), NULLs, orphans and exact copies."""
    rng = random.Random(7)
    left = [("hot", 1, rng.randrange(3)) for _ in range(60)] + [("left", 1, 5)] * 40 + [(None, 1, 8)] * 30
    left += [(f"k{i % 25}", i % 2, i) for i in range(60)]
    right = [("hot", 1, f"r{rng.randrange(9)}") for _ in range(50)] + [("right", 1, "same")] * 45 + [(None, 1, "n")] * 20
    right += [(f"k{i % 40}", i % 2, f"v{i}") for i in range(70)] + [("hot", None, "half")] * 5
    return (
        frame(spark, left, "k string, j int, a int"),
        frame(spark, right, "k string, j int, b string"),
    )


@pytest.mark.parametrize("how", ["left", "full"])
@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
def test_splitting_hot_keys_changes_no_row(skewed, how, keys):
    left, right = skewed
    if keys == ["k"]:
        right = right.drop("j")
    wanted = left.join(right, keys, how)
    got = spread_join(left, right, keys, how, rows_per_shard=7)
    assert got.columns == wanted.columns
    assert rows(got) == rows(wanted)


@pytest.mark.parametrize("how", ["left", "full"])
def test_probing_base_tables_gives_the_same(skewed, how):
    left, right = skewed
    got = spread_join(left, right, ["k", "j"], how, right_probes=[right], rows_per_shard=3)
    assert rows(got) == rows(left.join(right, ["k", "j"], how))


def test_hot_keys_are_found_and_counted(skewed):
    left, right = skewed
    assert hot_keys([left], [right], ["k", "j"], "full", 20) == {("hot", 1): (3, 3), ("left", 1): (2, 0), ("right", 1): (0, 3)}
    assert hot_keys([left], [right], ["k", "j"], "left", 20) == {("hot", 1): (1, 3), ("right", 1): (1, 3)}
    product = {tuple(r)[:2]: r[2] for r in key_rows([left, right], ["k", "j"], "n").collect()}
    assert product["hot", 1] == 3000 and product["left", 1] == 40


@pytest.mark.parametrize("how", ["left", "full"])
def test_counts_never_decide_which_rows_result(skewed, how):
    left, right = skewed
    more = right.union(right).union(left.selectExpr("k", "j", "'x'"))  # counts keys that the right side lacks
    got = spread_join(left, right, ["k", "j"], how, right_probes=[more], rows_per_shard=5)
    assert rows(got) == rows(left.join(right, ["k", "j"], how))


def test_a_joined_side_is_not_run_to_count_its_keys(spark, skewed):
    left, right = skewed
    ran = spark.sparkContext.accumulator(0)
    counted = spark.createDataFrame(right.rdd.map(lambda r: (ran.add(1), tuple(r))[1]), right.schema)
    joined = left.join(counted.select("k", "b"), "k")
    spread_join(joined, right.drop("b"), ["k", "j"], "left", rows_per_shard=1)
    assert ran.value == 0


def test_even_keys_take_the_plain_join(spark):
    left, right = spark.range(2000).withColumnRenamed("id", "k"), spark.range(3000).withColumnRenamed("id", "k")
    assert hot_keys([left], [right], ["k"], "full", 10) == {}
    got = spread_join(left, right, ["k"], "full")
    assert "_shards_left" not in got._jdf.queryExecution().toString()
    assert got.count() == 3000


def test_null_keys_of_a_full_join_are_dealt_out(spark):
    left = frame(spark, [(None, i) for i in range(400)], "k int, a int", 8)
    right = frame(spark, [(None, i) for i in range(300)], "k int, b int", 8)
    joined = plain_join(left, right, ["k"], "full")
    assert joined.columns == ["k", "a", "b"]
    assert joined.count() == 700
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = plain_join(left, right, ["k"], "full").rdd.glom().map(len).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 300


def test_hot_rows_are_spread_over_tasks(spark):
    left = frame(spark, [("hot", 1)] + [(f"k{i}", i) for i in range(50)], "k string, a int", 4)
    right = frame(spark, [("hot", i) for i in range(4000)], "k string, b int", 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spread_join(left, right, ["k"], "left", rows_per_shard=100)
        sizes = joined.rdd.glom().map(len).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4050
    assert max(sizes) < 1500


def test_key_types_must_agree(spark):
    left, right = spark.range(3), spark.range(3).selectExpr("cast(id as string) as id")
    with pytest.raises(ValueError, match="same type"):
        spread_join(left, right, ["id"])
    with pytest.raises(ValueError, match="unsupported"):
        spread_join(left, left, ["id"], "inner")


def test_registered_hot_keys_take_the_grid(spark):
    from tiers.registry.queries import all_queries

    for name in ("purchase_view_hot_key", "explore_outer_hot_key"):
        plan = all_queries()[name](spark, "/root/testdata/sf0.01")._jdf.queryExecution().toString()
        assert "_shards_left" in plan, name


def test_a_hot_left_side_is_split_if_asked_for(spark, skewed):
    left, right = skewed
    one_each = right.dropDuplicates(["k"]).drop("j")
    got = spread_join(left, one_each, ["k"], "left", rows_per_shard=7, split_left=True)
    assert rows(got) == rows(left.join(one_each, ["k"], "left"))
