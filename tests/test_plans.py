import random
import uuid
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tiers.functions.names import raw_feed
from tiers.plans.adhoc import (
    adhoc_output,
    explore_outer,
    explore_outer_counts,
    load_feeds,
    profile_feeds,
    purchase_view,
)
from tiers.plans.gold import gold_output, gold_output_outer_form
from tiers.plans.refresh import run
from tiers.plans.silver import last_load, loaded_from, silver_refresh
from tiers.sinks.tables import ensure_schema, ensure_table
from tiers.specs import AVOCADO, SPECS

BEGIN = datetime(2024, 1, 1)


def rows(df, *without):
    return Counter(tuple(r) for r in df.drop(*without).collect())


def text_feeds(spark, seed=1, n=120):
    """Small random feeds: NULL and unreadable keys, orphans, repeated keys, bad dates."""
    rng = random.Random(seed)

    def key(top):
        return rng.choice([None, "bad", *[str(rng.randrange(top)) for _ in range(8)]])

    def day():
        return rng.choice([None, "soon", *[str(date(2024, 1, 1) + timedelta(rng.randrange(9))) for _ in range(8)]])

    def value(column):
        if column in ("purchaseid", "fertilizerid"):
            return key(30)
        if column == "consumerid":
            return rng.choice([None, "C-x", *[str(rng.randrange(8)) for _ in range(6)]])
        if column.endswith("_date"):
            return day()
        return rng.choice([None, "1", "2", " 3 ", "4.5", "odd"])

    feeds = {}
    for name, spec in SPECS.items():
        data = [
            (*[value(c) for c in spec.feed_order], f"{rng.randrange(3)}.csv", BEGIN + timedelta(days=rng.randrange(4)))
            for _ in range(n)
        ]
        feeds[name] = spark.createDataFrame(data, spec.bronze_schema).repartition(3)
    return feeds


def silver_frames(spark, seed, n=200):
    """Silver-like frames keyed as silver is, with orphans on every side."""
    rng = random.Random(seed)
    start = date(2024, 1, 1)

    def some(top):
        return rng.sample(range(top), top // 2)

    consumer = [(str(c), rng.choice(["F", "M", None]), rng.choice([20, None])) for c in some(12)]
    purchase = [(p, str(rng.randrange(12))) for p in some(n)]
    owner = dict(purchase)
    avocado = [
        (p, owner.get(p, "1") if rng.random() < 0.8 else "2", *[start + timedelta(rng.randrange(9)) for _ in range(3)], 1)
        for p in some(n)
    ]
    fertilizer = [
        (f, p, owner.get(p, "1") if rng.random() < 0.8 else "3", rng.choice(["a", "b", None]))
        for f, p in enumerate(rng.choices(range(n), k=n))
    ]
    return {
        "consumer": spark.createDataFrame(consumer, "consumerid string, sex string, age int"),
        "purchase": spark.createDataFrame(purchase, "purchaseid bigint, consumerid string"),
        "avocado": spark.createDataFrame(
            avocado,
            "purchaseid bigint, consumerid string, born_date date, picked_date date, sold_date date, "
            "ripe_index_when_picked int",
        ),
        "fertilizer": spark.createDataFrame(
            fertilizer, "fertilizerid int, purchaseid bigint, consumerid string, type string"
        ),
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_gold_equals_the_literal_chain_of_full_joins(spark, seed):
    frames = silver_frames(spark, seed)
    wanted = rows(gold_output_outer_form(**frames))
    assert sum(wanted.values()) > 5
    assert rows(gold_output(**frames)) == wanted
    assert rows(gold_output(**frames, rows_per_shard=2)) == wanted
    assert rows(gold_output_outer_form(**frames, rows_per_shard=2)) == wanted


def test_gold_consumer_id_as_a_number(spark):
    frames = silver_frames(spark, 5)
    got = gold_output(**frames, consumer_id_type="bigint")
    assert got.schema["consumer_id"].dataType.simpleString() == "bigint"
    assert got.count() == gold_output(**frames).count()


def test_views_do_not_depend_on_splitting_hot_keys(spark):
    feeds = text_feeds(spark)
    core = {name: df.drop("raw_file_name", "load_timestamp") for name, df in feeds.items()}
    forced = {"rows_per_shard": 4}
    assert rows(purchase_view(**feeds)) == rows(purchase_view(**feeds, **forced))
    assert rows(explore_outer(**core)) == rows(explore_outer(**core, **forced))



@pytest.mark.parametrize("forced", [{}, {"rows_per_shard": 4}])
def test_outer_counts_equal_counted_rows_of_the_outer_view(spark, forced):
    feeds = text_feeds(spark, seed=4)
    core = {name: df.drop("raw_file_name", "load_timestamp") for name, df in feeds.items()}
    # One key held many times on every side: its rows multiply.
    hot = {name: df.where(F.pmod(F.xxhash64(*df.columns), F.lit(5)) == 0).withColumn("purchaseid", F.lit("7")) for name, df in core.items()}
    core = {name: df.union(hot[name]) if name != "consumer" else df for name, df in core.items()}
    by = ["purchaseid", "sex", "type", "plu"]
    wanted = explore_outer(**core).groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))
    got = explore_outer_counts(**core, consumer_by=["sex"], avocado_by=["plu"], fertilizer_by=["type"], **forced)
    assert rows(got.select(*by, "row_count")) == rows(wanted)
    assert max(r.row_count for r in got.collect()) >= 10 * 10


def test_gold_plan_moves_each_input_once(spark, tmp_path):
    frames = {}
    for name, df in silver_frames(spark, 1).items():
        df.write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = gold_output(**frames)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 5  # four inputs, and the result once to meet the consumers
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def bronze_tables(spark, tmp_path, feeds):
    schema = f"p_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, schema, str(tmp_path / schema))
    for name, df in feeds.items():
        ensure_table(spark, f"{schema}.{name}", SPECS[name].bronze_schema)
        df.write.insertInto(f"{schema}.{name}")
    return schema


@pytest.mark.parametrize("name", ["avocado", "fertilizer"])
def test_silver_refresh_is_idempotent_but_for_the_update_time(spark, tmp_path, name):
    feeds = text_feeds(spark, 4)
    schema = bronze_tables(spark, tmp_path, {name: feeds[name]})
    tables = [f"{schema}.{t}" for t in (name, "silver", "rejects")]
    found = []
    for now in ("2024-03-01 00:00:00", "2024-03-02 00:00:00"):
        silver_refresh(spark, SPECS[name], *tables, now=now)
        found.append((rows(spark.table(tables[1]), "updated_at"), rows(spark.table(tables[2]), "updated_at")))
        assert spark.table(tables[1]).schema == SPECS[name].silver_schema
    assert found[0] == found[1]
    assert all(sum(c.values()) for c in found[0])


@pytest.mark.parametrize("buckets", [None, 3])
def test_incremental_silver_equals_full_silver(spark, tmp_path, buckets):
    """Bronze grows day by day; one job re-reads everything, the other only what is new."""
    feed = text_feeds(spark, 6, 200)["avocado"].cache()
    schema = bronze_tables(spark, tmp_path, {"avocado": feed.limit(0)})
    bronze = f"{schema}.avocado"
    previous = None
    for day in range(4):
        loaded = BEGIN + timedelta(days=day)
        feed.filter(F.col("load_timestamp") == F.lit(loaded)).write.insertInto(bronze)
        silver_refresh(spark, AVOCADO, bronze, f"{schema}.full", f"{schema}.full_rejects", buckets=buckets)
        silver_refresh(
            spark, AVOCADO, bronze, f"{schema}.step", f"{schema}.step_rejects", since=previous, buckets=buckets
        )
        previous = loaded
        silver_refresh(
            spark, AVOCADO, bronze, f"{schema}.auto", f"{schema}.auto_rejects", buckets=buckets, incremental=True
        )
        if day == 1:
            # As if the run had broken off between the two tables: the log catches up by itself.
            spark.sql(f"DROP TABLE {schema}.auto_rejects")
    for table in ("", "_rejects"):
        full = spark.table(f"{schema}.full{table}")
        assert full.count() > 0
        for way in ("step", "auto"):
            assert rows(full, "updated_at") == rows(spark.table(f"{schema}.{way}{table}"), "updated_at")


def test_incremental_silver_filters_in_the_scan(spark, tmp_path):
    schema = bronze_tables(spark, tmp_path, {"avocado": text_feeds(spark, 6, 50)["avocado"]})
    bronze = spark.table(f"{schema}.avocado")
    last = last_load(spark, f"{schema}.avocado")
    assert last_load(spark, f"{schema}.nothing") is None and loaded_from(bronze, None) is bronze
    newest = loaded_from(bronze, last)
    assert 0 < newest.count() < bronze.count()
    assert "GreaterThanOrEqual(load_timestamp" in newest._jdf.queryExecution().executedPlan().toString()


def deliver(df, spec, folder):
    raw_feed(df, spec).coalesce(2).write.mode("append").option("header", True).csv(folder)


def test_run_from_feeds_to_gold(spark, tmp_path):
    feeds = text_feeds(spark, 9, 200)
    folders = {name: str(tmp_path / "feeds" / name) for name in SPECS}
    for name, df in feeds.items():
        deliver(df, SPECS[name], folders[name])
    prefix = f"r_{uuid.uuid4().hex[:8]}_"

    def refresh(now):
        return run(spark, folders, str(tmp_path / "checkpoints"), prefix, str(tmp_path), now=now, buckets=3)

    table = refresh("2024-03-01 00:00:00")
    assert table == f"{prefix}gold.output"
    first = rows(spark.table(table), "updated_at")
    rejected = {name: spark.table(f"{prefix}silver.{name}_rejects").count() for name in SPECS}
    silver = {name: spark.table(f"{prefix}silver.{name}") for name in SPECS}
    assert first == rows(gold_output(**silver)) and sum(first.values()) > 0
    assert all(rejected.values())

    refresh("2024-03-02 00:00:00")
    assert rows(spark.table(table), "updated_at") == first
    assert {r[0] for r in spark.table(table).select(F.date_format("updated_at", "d")).distinct().collect()} == {"2"}
    assert {name: spark.table(f"{prefix}silver.{name}_rejects").count() for name in SPECS} == rejected


def test_adhoc_from_files_to_text(spark, tmp_path):
    feeds = text_feeds(spark, 11)
    paths = {name: str(tmp_path / name) for name in SPECS}
    for name, df in feeds.items():
        deliver(df, SPECS[name], paths[name])
    loaded = load_feeds(spark, paths)
    assert all(df.columns == list(SPECS[name].feed_order) for name, df in loaded.items())
    target = adhoc_output(spark, paths, str(tmp_path), 2, date(2024, 3, 1))
    assert target.endswith("/target_2_2024-03-01.csv")
    back = spark.read.csv(target, header=True, sep="|")
    assert back.columns[0] == "consumerid" and back.count() == purchase_view(**loaded).count() > 0
    report = profile_feeds(loaded)["avocado"]
    figures = {(r["column_name"], r["figure"]): r["value"] for r in report.collect()}
    assert figures["*", "row_count"] == "120" and int(figures["*", "duplicate_keys"]) > 5
