import uuid
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tiers.functions.names import identifier, normalize_names, raw_feed, rename_feed
from tiers.sinks.tables import ensure_schema
from tiers.sources.csv import read_drops, read_feed, scan_text, with_metadata
from tiers.sources.workdir import new_folder, work_root
from tiers.specs import AVOCADO, CONSUMER, PURCHASE
from tiers.streaming.ingest import ingest, ingest_as_found, write_stream, stream_files

NOW = "2024-03-01 06:00:00"


@pytest.fixture
def schema(spark, tmp_path):
    name = f"i_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, name, str(tmp_path / name))
    return name


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()

    def write(name, *lines):
        (folder / name).write_text("\n".join(lines) + "\n")
        return str(folder)

    return write


HEADER = "consumerid,sex,ethnicity,race,age"


def ids(df):
    return Counter(r["consumerid"] for r in df.collect())


def test_stream_takes_every_file_once(spark, schema, feed, tmp_path):
    table, checkpoints = f"{schema}.consumer", str(tmp_path / "checkpoints")
    folder = feed("1.csv", HEADER, "a,F,x,y,1", "b,M,x,y,")
    for _ in range(2):
        ingest(spark, CONSUMER, folder, table, checkpoints, now=NOW)
    assert ids(spark.table(table)) == {"a": 1, "b": 1}
    feed("2.csv", HEADER, "c,F,x,y,3")
    ingest(spark, CONSUMER, folder, table, checkpoints, now=NOW, files_per_batch=1)
    got = spark.table(table)
    assert ids(got) == {"a": 1, "b": 1, "c": 1}
    assert got.schema == CONSUMER.bronze_schema
    assert {r["raw_file_name"].rsplit("/", 1)[1] for r in got.collect()} == {"1.csv", "2.csv"}
    assert got.filter("age is null").count() == 1
    assert got.select(F.date_format("load_timestamp", "yyyy-MM-dd HH:mm:ss")).distinct().first()[0] == NOW


def test_stream_refuses_a_moved_column(spark, schema, feed, tmp_path):
    folder = feed("1.csv", "sex,consumerid,ethnicity,race,age", "F,a,x,y,1")
    with pytest.raises(PySparkException):
        ingest(spark, CONSUMER, folder, f"{schema}.consumer", str(tmp_path / "c"))


def test_continuous_stream(spark, schema, feed, tmp_path):
    folder = feed("1.csv", HEADER, "a,F,x,y,1")
    rows = rename_feed(stream_files(spark, folder, CONSUMER.raw_schema), CONSUMER)
    query = write_stream(rows, f"{schema}.live", str(tmp_path / "c"), every="1 second")
    try:
        query.processAllAvailable()
        feed("2.csv", HEADER, "b,F,x,y,1")
        query.processAllAvailable()
    finally:
        query.stop()
    assert ids(spark.table(f"{schema}.live")) == {"a": 1, "b": 1}


@pytest.mark.parametrize("infer_types,kind", [(False, "string"), (True, "int")])
def test_feed_without_spec(spark, schema, feed, tmp_path, infer_types, kind):
    table, checkpoints = f"{schema}.found", str(tmp_path / "c")
    folder = feed("1.csv", "Con ID,Sex", "7,F")
    ingest_as_found(spark, "found", folder, table, checkpoints, infer_types=infer_types)
    assert spark.table(table).dtypes[:2] == [("con_id", kind), ("sex", "string")]
    feed("2.csv", "Con ID,Sex", "8.5,M")  # by itself no whole number, but the column keeps its type
    ingest_as_found(spark, "found", folder, table, checkpoints, infer_types=infer_types)
    ids = {str(r[0]) for r in spark.table(table).collect()}
    assert ids == ({"7", "None"} if infer_types else {"7", "8.5"})


def test_batch_reader_is_strict_about_headers(spark, feed):
    header = ",".join(PURCHASE.raw_schema.names)
    folder = feed("1.csv", header, "1,c,2024-01-01,3,2024,QA1,5,6,7")
    row = read_feed(spark, PURCHASE, folder, now=NOW).first()
    assert (row["purchaseid"], row["qa_process"], row["price_index"]) == ("1", "QA1", "7")
    assert row["raw_file_name"].endswith("/1.csv")
    feed("2.csv", header.replace("purchaseid,consumerid", "consumerid,purchaseid"), "c,1,2024-01-01,3,2024,QA1,5,6,7")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_feed(spark, PURCHASE, folder).collect()


def test_drops_with_different_headers(spark, tmp_path):
    for name, text in {"a": "ID,Big Name\n1,x\n", "b": "Big Name,ID,extra\ny,2,e\n", "c": "ID,Big Name\n3,z\n"}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(text)
    got = read_drops(spark, [str(tmp_path / n) for n in "abc"], now=NOW)
    rows = {(r["id"], r["big_name"], r["extra"]) for r in got.collect()}
    assert rows == {("1", "x", None), ("2", "y", "e"), ("3", "z", None)}
    (tmp_path / "a" / "g.csv").write_text("Big Name,ID\nq,9\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_drops(spark, [str(tmp_path / "a")]).collect()
    with pytest.raises(ValueError, match="no drops"):
        read_drops(spark, [])


def test_plain_scan_is_all_text_and_reads_empty_as_null(spark, feed):
    df = scan_text(spark, feed("1.csv", "a,b c", '1,""', ",x"))
    assert df.dtypes == [("a", "string"), ("b c", "string")]
    assert [tuple(r) for r in df.collect()] == [("1", None), (None, "x")]


def test_names(spark):
    df = spark.createDataFrame([("v-1!",)], "` Ripe Index ` string")
    assert normalize_names(df).columns == ["ripe_index"]
    assert df.select(identifier(F.col("` Ripe Index `"))).first()[0] == "v_1_"
    with pytest.raises(ValueError, match="collide"):
        normalize_names(spark.createDataFrame([(1, 2)], "`A b` int, a_b int"))


def test_feed_names_round_trip(spark):
    df = spark.createDataFrame([tuple("12345678")], AVOCADO.raw_schema)
    named = rename_feed(df, AVOCADO)
    assert named.columns == list(AVOCADO.feed_order)
    assert raw_feed(named, AVOCADO).columns == df.columns
    assert normalize_names(df).columns == named.columns


def test_metadata(spark):
    got = with_metadata(spark.range(1), "f.csv").first()
    assert got["raw_file_name"] == "f.csv" and got["load_timestamp"] is not None


def test_work_folder_is_the_one_of_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert work_root(spark) == root
    assert new_folder(spark, "x").startswith(f"{root}/x-")
    assert new_folder(spark, "x") != new_folder(spark, "x")
