"""Tables in parts: what a change touches, what it leaves, and what a broken-off one costs."""

import os
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_plans import silver_frames

from tiers.plans.gold import changed_consumers, gold_refresh, only_consumers, refreshed_until
from tiers.plans.silver import TRACKED
from tiers.sinks import parted
from tiers.sinks.tables import append_rejects, ensure_schema, new_rejects, replace_by_key, upsert
from tiers.specs import SPECS


@pytest.fixture
def schema(spark, tmp_path):
    name = f"q_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, name, str(tmp_path / name))
    return name


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def frame(spark, data, columns="k int, v string"):
    return spark.createDataFrame(data, columns)


def files(spark, table):
    """Data files of each part, with the time they were written."""
    found = {}
    for path in spark.table(parted.store_of(table)).inputFiles():
        path = path.removeprefix("file://")
        part = int(path.rsplit(f"{parted.PART}=", 1)[1].split("/")[0])
        found.setdefault(part, set()).add((os.path.basename(path), os.stat(path).st_mtime_ns))
    return found


def parts_of(spark, table):
    return dict(spark.table(parted.store_of(table)).select("k", parted.PART).collect())


def test_files_of_untouched_parts_stay_the_same(spark, schema):
    table = f"{schema}.t"
    upsert(spark, table, frame(spark, [(i, "a") for i in range(200)]), ["k"], parts=7)
    before, place = files(spark, table), parts_of(spark, table)
    assert len(before) == 7
    done = parted.merge(spark, table, frame(spark, [(11, "B"), (12, "C")]), ["k"])
    after, touched = files(spark, table), {place[11], place[12]}
    assert set(done["rewritten"]) == touched and done["added"] == []
    assert all((before[p] == after[p]) == (p not in touched) for p in before)
    wanted = {(i, {11: "B", 12: "C"}.get(i, "a")): 1 for i in range(200)}
    assert rows(spark.table(table)) == wanted


def test_new_keys_are_added_without_rewriting(spark, schema):
    table = f"{schema}.t"
    upsert(spark, table, frame(spark, [(i, "a") for i in range(100)]), ["k"], parts=5)
    before = files(spark, table)
    done = parted.merge(spark, table, frame(spark, [(i, "new") for i in range(1000, 1010)]), ["k"])
    after = files(spark, table)
    assert done["rewritten"] == [] and done["added"]
    assert all(before[p] <= after[p] for p in before)
    assert spark.table(table).count() == 110


def test_only_parts_of_the_source_are_read(spark, schema):
    table = f"{schema}.t"
    upsert(spark, table, frame(spark, [(i, "a") for i in range(50)]), ["k"], parts=6)
    store = spark.table(parted.store_of(table))
    staged = frame(spark, [(1, "x")]).withColumn(parted.PART, F.lit(2))
    looked_up = parted.winners(staged, parted._only(store, [2]), ["k"], True, None)
    plan = looked_up._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan and "ReadSchema: struct<k:int>" in plan


def test_the_view_shows_the_columns_and_widens(spark, schema):
    table = f"{schema}.t"
    upsert(spark, table, frame(spark, [(1, "a"), (2, "b")]), ["k"], parts=3)
    assert spark.table(table).columns == ["k", "v"]
    upsert(spark, table, frame(spark, [(9, 2, "B")], "n int, k int, v string"), ["k"])
    assert rows(spark.table(table).select("k", "v", "n")) == {(1, "a", None): 1, (2, "B", 9): 1}
    with pytest.raises(ValueError, match="lacks columns.*n"):
        upsert(spark, table, frame(spark, [(3, "c")]), ["k"])


def test_null_keys_match_nothing_and_are_spread(spark, schema):
    table = f"{schema}.t"
    for _ in range(2):
        upsert(spark, table, frame(spark, [(None, f"v{i}") for i in range(60)] + [(1, "a")]), ["k"], parts=4)
    assert spark.table(table).where("k is null").count() == 120 and spark.table(table).count() == 121
    assert spark.table(parted.store_of(table)).where("k is null").select(parted.PART).distinct().count() == 4


def test_replace_by_key_in_parts(spark, schema):
    table = f"{schema}.t"
    replace_by_key(spark, table, frame(spark, [(1, "a"), (1, "b"), (2, "c"), (None, "d")]), ["k"], parts=3)
    replace_by_key(spark, table, frame(spark, [(1, "x"), (1, "x"), (None, "y"), (3, "z")]), ["k"])
    assert rows(spark.table(table)) == {(1, "x"): 2, (2, "c"): 1, (None, "y"): 1, (3, "z"): 1}


def test_repeated_keys_change_nothing(spark, schema):
    table = f"{schema}.t"
    with pytest.raises(ValueError, match="several rows"):
        upsert(spark, table, frame(spark, [(1, "x"), (1, "y")]), ["k"], parts=2)
    assert not spark.catalog.listTables(schema)
    upsert(spark, table, frame(spark, [(1, "a")]), ["k"], parts=2)
    with pytest.raises(ValueError, match="several rows"):
        upsert(spark, table, frame(spark, [(1, "x"), (1, "y")]), ["k"])
    assert rows(spark.table(table)) == {(1, "a"): 1}
    assert sorted(t.name for t in spark.catalog.listTables(schema)) == ["t", "t__store"]


def test_the_key_has_to_hold_the_layout(spark, schema):
    table = f"{schema}.t"
    upsert(spark, table, frame(spark, [(1, "a"), (2, "b")]), ["k"], parts=2)
    with pytest.raises(ValueError, match="laid out by k"):
        upsert(spark, table, frame(spark, [(1, "a")]), ["v"])
    upsert(spark, table, frame(spark, [(1, "a"), (1, "c")]), ["k", "v"])
    assert rows(spark.table(table)) == {(1, "a"): 1, (1, "c"): 1, (2, "b"): 1}


@pytest.mark.parametrize("seed", [1, 2])
def test_deliveries_in_any_order_end_alike(spark, schema, seed):
    rng = random.Random(seed)
    columns = "k int, v string, t int"
    deliveries = [[(k, f"{k}-{t}", t) for k in rng.sample(range(30), 12)] for t in (1, 2, 3, 4)]
    latest = {}
    for k, v, t in (r for d in deliveries for r in d):
        latest[k] = max(latest.get(k, (0, "")), (t, v))
    for layout in ({"parts": 3}, {"buckets": 2}, {}):
        order = [*deliveries, deliveries[rng.randrange(4)]]
        rng.shuffle(order)
        table = f"{schema}.t_{'_'.join(layout) or 'plain'}"
        for d in order:
            upsert(spark, table, frame(spark, d, columns), ["k"], newer="t", **layout)
        assert rows(spark.table(table)) == {(k, v, t): 1 for k, (t, v) in latest.items()}


def test_an_unknown_version_is_the_oldest(spark, schema):
    table, columns = f"{schema}.t", "k int, v string, t int"
    upsert(spark, table, frame(spark, [(1, "a", None), (2, "b", 5), (3, "c", None)], columns), ["k"], parts=2, newer="t")
    upsert(spark, table, frame(spark, [(1, "A", 1), (2, "B", None), (3, "C", None)], columns), ["k"], newer="t")
    assert rows(spark.table(table).select("k", "v")) == {(1, "A"): 1, (2, "b"): 1, (3, "C"): 1}


def test_a_late_delivery_that_loses_rewrites_nothing(spark, schema):
    table, columns = f"{schema}.t", "k int, t int"
    upsert(spark, table, frame(spark, [(i, 5) for i in range(40)], columns), ["k"], parts=4, newer="t")
    before = files(spark, table)
    done = parted.merge(spark, table, frame(spark, [(i, 4) for i in range(40)], columns), ["k"], newer="t")
    assert done == {"rewritten": [], "added": []} and files(spark, table) == before


def test_a_replacement_that_was_cut_short_is_finished(spark, schema, monkeypatch):
    table = f"{schema}.t"
    upsert(spark, table, frame(spark, [(i, "a") for i in range(20)]), ["k"], parts=3)
    cut = RuntimeError("driver lost")

    def stop(*_):
        raise cut

    replace = parted._replace
    monkeypatch.setattr(parted, "_replace", stop)
    with pytest.raises(RuntimeError):
        upsert(spark, table, frame(spark, [(3, "B"), (99, "n")]), ["k"])
    monkeypatch.setattr(parted, "_replace", replace)
    parted.recover(spark, table)
    assert rows(spark.table(table).where("v != 'a'")) == {(3, "B"): 1, (99, "n"): 1}
    assert sorted(t.name for t in spark.catalog.listTables(schema)) == ["t", "t__store"]


def test_a_write_that_never_got_there_leaves_the_table(spark, schema, monkeypatch):
    table = f"{schema}.t"
    upsert(spark, table, frame(spark, [(1, "a")]), ["k"], parts=2)
    frame(spark, [(1, "b")]).withColumn(parted.PART, F.lit(0)).write.saveAsTable(f"{table}__stage_12345678")
    spark.sql(f"DROP VIEW {table}")  # as if the driver had died before it was made
    parted.recover(spark, table)
    assert rows(spark.table(table)) == {(1, "a"): 1}
    frame(spark, [(1, "b")]).write.saveAsTable(parted.store_of(f"{schema}.u"))  # a first write, not finished
    upsert(spark, f"{schema}.u", frame(spark, [(5, "x")]), ["k"], parts=2)
    assert rows(spark.table(f"{schema}.u")) == {(5, "x"): 1}


def test_a_plain_table_is_taken_over(spark, schema):
    table = f"{schema}.t"
    upsert(spark, table, frame(spark, [(1, "a"), (2, "b")]), ["k"])
    upsert(spark, table, frame(spark, [(2, "B"), (3, "c")]), ["k"], parts=3)
    assert rows(spark.table(table)) == {(1, "a"): 1, (2, "B"): 1, (3, "c"): 1}
    assert parted.layout(spark, table) == (["k"], 3)


def test_changes_are_noted_with_old_and_new_values(spark, schema):
    table, columns = f"{schema}.t", "k int, c string"
    for now, data in (("2024-01-01", [(1, "a"), (2, "b")]), ("2024-01-02", [(1, "z"), (3, "c")])):
        at = F.lit(now).cast("timestamp")
        upsert(spark, table, frame(spark, data, columns), ["k"], parts=2, track=["c"], at=at)
    log = spark.table(parted.changes_of(table))
    found = {(r.c, str(r.changed_at)[:10]) for r in log.collect()}
    assert found == {("a", "2024-01-01"), ("b", "2024-01-01"), ("a", "2024-01-02"), ("z", "2024-01-02"), ("c", "2024-01-02")}
    assert "PartitionFilters: [isnotnull(change_day" in log.where("change_day >= date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()


# Gold by change


def deliver(spark, silver, frames, now):
    for name, df in frames.items():
        at = F.lit(now).cast("timestamp")
        upsert(spark, silver[name], df, SPECS[name].merge_key, known_unique=True, parts=3, track=TRACKED, at=at)


def no_repeats(name, df):
    return df.dropDuplicates(list(SPECS[name].merge_key))


@pytest.mark.parametrize("seed", [1, 2])
def test_gold_by_change_equals_gold_anew(spark, schema, seed):
    """Deliveries of all kinds; purchases and avocados change their consumer between them."""
    rng = random.Random(seed)
    silver = {name: f"{schema}.{name}" for name in SPECS}
    ways = {way: f"{schema}.gold_{way}" for way in ("anew", "change")}
    for step in range(4):
        frames = {name: no_repeats(name, df) for name, df in silver_frames(spark, 100 * seed + step, 60).items()}
        if step:
            frames = {name: df.sample(0.2, step) for name, df in frames.items() if rng.random() < 0.7}
        now = f"2024-02-0{step + 1} 00:00:00"
        deliver(spark, silver, frames, now)
        for way, table in ways.items():
            gold_refresh(spark, silver, table, now, incremental=way == "change", parts=3)
        found = [rows(spark.table(table).drop("updated_at")) for table in ways.values()]
        assert found[0] == found[1] and found[0]
    untouched = spark.table(ways["change"]).where("updated_at < timestamp'2024-02-04'").count()
    assert untouched > 0


def test_gold_by_change_does_not_join_other_consumers(spark, schema):
    silver = {name: f"{schema}.{name}" for name in SPECS}
    deliver(spark, silver, {n: no_repeats(n, df) for n, df in silver_frames(spark, 5, 80).items()}, "2024-02-01")
    table = f"{schema}.gold"
    gold_refresh(spark, silver, table, "2024-02-01", incremental=True, parts=3)
    last = refreshed_until(spark, table)
    assert last and changed_consumers(spark, silver, last).count() == 0
    before = files(spark, table)
    gold_refresh(spark, silver, table, "2024-02-02", incremental=True)
    assert files(spark, table) == before  # nothing changed, nothing was written
    moved = spark.table(silver["consumer"]).limit(1).withColumn("sex", F.lit("?"))
    deliver(spark, silver, {"consumer": spark.createDataFrame(moved.collect(), moved.schema)}, "2024-02-03")
    changed = changed_consumers(spark, silver, last)
    assert changed.count() == 1
    left = only_consumers({name: spark.table(t) for name, t in silver.items()}, changed)
    for name, df in left.items():
        assert {r.consumerid for r in df.collect()} <= {changed.first()[0]}, name
        assert "LeftSemi" in df._jdf.queryExecution().executedPlan().toString()


# Reject log by load time


def test_the_reject_log_is_read_by_load_time(spark, schema):
    table = f"{schema}.log"

    def some(*data):
        return spark.createDataFrame(data, "reject_id string, day string, v int").select(
            "reject_id", F.col("day").cast("timestamp").alias("load_timestamp"), "v"
        )

    first = some(("a", "2024-01-01", 1), ("b", "2024-02-02", 2), ("n", None, 3))
    second = some(("b", "2024-02-02", 2), ("c", "2024-02-02", 4), ("n", None, 3), ("m", None, 5))
    for batch in (first, first, second, second):
        append_rejects(spark, table, batch)
    log = spark.table(table)
    assert rows(log.select("reject_id", "v")) == {("a", 1): 1, ("b", 2): 1, ("n", 3): 1, ("c", 4): 1, ("m", 5): 1}
    staged = some(("x", "2024-02-02", 1)).withColumn("load_month", F.trunc("load_timestamp", "month"))
    plan = new_rejects(staged, log)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_month" in plan and "= 2024-02-01)" in plan, plan
    assert "IsNotNull(load_timestamp)" in plan, plan
    assert not [t for t in spark.catalog.listTables(schema) if "__" in t.name]
