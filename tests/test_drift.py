"""Streams of files whose headers change, and types found where nobody named them."""

import uuid
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from tiers.sinks.tables import ensure_schema
from tiers.specs import PURCHASE
from tiers.streaming import drift
from tiers.streaming.drift import BATCH, ingest_drifting
from tiers.streaming.inference import inferred
from tiers.streaming.ingest import found_schema

NOW = "2024-03-01 06:00:00"


@pytest.fixture
def schema(spark, tmp_path):
    name = f"d_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, name, str(tmp_path / name))
    return name


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()

    def write(name, *lines):
        (folder / name).write_text("".join(f"{line}\n" for line in lines))
        return str(folder)

    return write


def rows(spark, table, *columns):
    return Counter(tuple(r) for r in spark.table(table).select(*columns).collect())


def test_moved_and_new_columns_in_one_folder(spark, schema, feed, tmp_path):
    table, checkpoints = f"{schema}.t", str(tmp_path / "c")
    feed("1.csv", "ID,Big Name", "1,one", "2,two")
    feed("2.csv", "Big Name,ID", "three,3")
    folder = feed("3.csv", "ID,extra,Big Name", "4,x,four", ",y,")
    feed("empty.csv")
    ingest_drifting(spark, "t", folder, table, checkpoints, now=NOW)
    wanted = {("1", "one", None): 1, ("2", "two", None): 1, ("3", "three", None): 1, ("4", "four", "x"): 1, (None, None, "y"): 1}
    assert rows(spark, table, "id", "big_name", "extra") == wanted
    assert {f.rsplit("/", 1)[1] for (f,) in rows(spark, table, "raw_file_name")} == {"1.csv", "2.csv", "3.csv"}
    feed("4.csv", "other,ID", "o,5")
    for _ in range(2):
        ingest_drifting(spark, "t", folder, table, checkpoints, now=NOW)
    assert rows(spark, table, "id", "other") == {**{(i, None): 1 for i in ("1", "2", "3", "4", None)}, ("5", "o"): 1}
    assert spark.table(table).select(BATCH).distinct().count() == 2


def test_a_batch_that_runs_again_adds_nothing(spark, schema, feed, tmp_path, monkeypatch):
    table, checkpoints = f"{schema}.t", str(tmp_path / "c")
    folder = feed("1.csv", "a,b", "1,2")
    ingest_drifting(spark, "t", folder, table, checkpoints, now=NOW)
    feed("2.csv", "b,a", "4,3")
    write = drift.write_batch

    def write_and_fail(*args):
        write(*args)
        raise RuntimeError("driver lost after the write, before the checkpoint")

    monkeypatch.setattr(drift, "write_batch", write_and_fail)
    with pytest.raises(Exception, match="driver lost"):
        ingest_drifting(spark, "t", folder, table, checkpoints, now=NOW)
    assert rows(spark, table, "a", "b") == {("1", "2"): 1, ("3", "4"): 1}
    monkeypatch.setattr(drift, "write_batch", write)
    ingest_drifting(spark, "t", folder, table, checkpoints, now=NOW)
    assert rows(spark, table, "a", "b") == {("1", "2"): 1, ("3", "4"): 1}


def test_small_batches_and_a_spec(spark, schema, feed, tmp_path):
    table, header = f"{schema}.t", [c.raw for c in PURCHASE.columns]
    for i in range(5):
        turned = header[i:] + header[:i]
        folder = feed(f"{i}.csv", ",".join(turned), ",".join(f"{h}-{i}" for h in turned))
    ingest_drifting(spark, "t", folder, table, str(tmp_path / "c"), now=NOW, spec=PURCHASE, files_per_batch=2)
    assert rows(spark, table, "purchaseid", "qa_process") == {(f"purchaseid-{i}", f"QA process-{i}"): 1 for i in range(5)}
    assert spark.table(table).select(BATCH).distinct().count() == 3


def test_colliding_headers_are_refused(spark, schema, feed, tmp_path):
    folder = feed("1.csv", "A b,a_B", "1,2")
    with pytest.raises(Exception, match="collide"):
        ingest_drifting(spark, "t", folder, f"{schema}.t", str(tmp_path / "c"))


def test_headers_are_the_only_thing_read_twice(spark, feed):
    feed("1.csv", "a,b", "1,2")
    feed("2.csv", "a,b", "1,2")
    folder = feed("3.csv", "b,a", "1,2")
    paths = [f"file://{folder}/{i}.csv" for i in (1, 2, 3)]
    found = drift.headers(spark, paths)
    assert found == {("a", "b"): paths[:2], ("b", "a"): paths[2:]}
    plan = drift.read_by_header(spark, paths)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2


def test_types_are_inferred_once_and_kept(spark, schema, feed, tmp_path):
    table, checkpoints = f"{schema}.t", str(tmp_path / "c")
    folder = feed("1.csv", "n,when", "7,2024-01-05")
    ingest_drifting(spark, "t", folder, table, checkpoints, infer_types=True)
    feed("2.csv", "when,n,x", "soon,8.5,1.5")
    ingest_drifting(spark, "t", folder, table, checkpoints, infer_types=True)
    assert dict(spark.table(table).dtypes)["n"] == "int" and dict(spark.table(table).dtypes)["x"] == "double"
    assert rows(spark, table, "n", "when", "x") == {(7, date(2024, 1, 5), None): 1, (None, None, 1.5): 1}


@pytest.mark.parametrize(
    "values,kind",
    [
        (["1", "-2", None], T.IntegerType()),
        (["1", "9999999999"], T.LongType()),
        (["1", "2.5", ".5", "1e3"], T.DoubleType()),
        (["2024-01-05", None], T.DateType()),
        (["2024-01-05 10:00:00", "2024-01-05T10:00"], T.TimestampType()),
        (["true", "FALSE"], T.BooleanType()),
        (["2024-01-05", "1"], T.StringType()),
        ([" 1"], T.StringType()),
        (["2024-02-31"], T.StringType()),
        ([None, None], T.StringType()),
    ],
)
def test_the_narrowest_type_that_fits(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "`odd name` string")
    assert inferred(df, ["odd name"]) == {"odd name": kind}
    assert inferred(df, []) == {}


def test_only_new_columns_are_looked_at(spark, schema, feed):
    folder = feed("1.csv", "k,v", "1,2024-01-01 10:00:00")
    assert found_schema(spark, folder, f"{schema}.t", True).fieldNames() == ["k", "v"]
    spark.sql(f"CREATE TABLE {schema}.t (k string, v timestamp) USING parquet")
    assert [f.dataType.simpleString() for f in found_schema(spark, folder, f"{schema}.t", True)] == ["string", "timestamp"]
    spark.sql(f"DROP TABLE {schema}.t")
    spark.createDataFrame([(datetime(2024, 1, 1),)], "v timestamp").write.saveAsTable(f"{schema}.t")
    assert [f.dataType.simpleString() for f in found_schema(spark, folder, f"{schema}.t", True)] == ["int", "timestamp"]
