"""Counts taken along by writes."""

import uuid

from test_plans import bronze_tables, text_feeds

from tiers.operators.counts import counted, rows_seen, rows_taken
from tiers.plans.refresh import log_counts
from tiers.plans.silver import clean_rows, rejected_rows, silver_refresh
from tiers.specs import AVOCADO, CONSUMER
from tiers.streaming.ingest import ingest


def test_counts_come_with_the_write(spark, tmp_path):
    rows, seen = counted(spark.range(7))
    rows.write.parquet(str(tmp_path / "t"))
    assert rows_seen(seen) == 7
    none, seen = counted(spark.range(7).where("id > 9"))
    none.write.parquet(str(tmp_path / "n"))
    assert rows_seen(seen) == 0


def test_a_silver_refresh_tells_what_it_did(spark, tmp_path):
    feed = text_feeds(spark, 4)["avocado"].cache()
    schema = bronze_tables(spark, tmp_path, {"avocado": feed})
    tables = [f"{schema}.{t}" for t in ("avocado", "silver", "rejects")]
    for _ in range(2):
        counts = silver_refresh(spark, AVOCADO, *tables, parts=2)
        assert counts == {
            "rows_in": feed.count(),
            "kept": clean_rows(feed, AVOCADO).count(),
            "rejected": rejected_rows(feed, AVOCADO).count(),
        }
    spark.sql(f"TRUNCATE TABLE {tables[0]}")
    assert silver_refresh(spark, AVOCADO, *tables) == {"rows_in": 0, "kept": 0, "rejected": 0}


def test_counting_adds_no_scan(spark, tmp_path):
    feed = text_feeds(spark, 4)["avocado"]
    schema = bronze_tables(spark, tmp_path, {"avocado": feed})
    rows, _ = counted(clean_rows(counted(spark.table(f"{schema}.avocado"))[0], AVOCADO))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 2


def test_a_stream_counts_what_it_takes(spark, tmp_path):
    schema = f"n_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path}/{schema}'")
    folder = tmp_path / "feed"
    folder.mkdir()
    header = ",".join(CONSUMER.raw_schema.names)
    (folder / "1.csv").write_text(f"{header}\na,F,x,y,1\nb,F,x,y,1\n")
    taken = [rows_taken(ingest(spark, CONSUMER, str(folder), f"{schema}.t", str(tmp_path / "c"))) for _ in range(2)]
    assert taken == [2, 0]
    for counts in ([("a", "bronze", "rows_in", 2)], [("a", "bronze", "rows_in", 0)]):
        log_counts(spark, f"{schema}.load_counts", counts, "2024-01-01")
    assert [r.row_count for r in spark.table(f"{schema}.load_counts").orderBy("row_count").collect()] == [0, 2]
