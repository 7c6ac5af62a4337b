"""The daily job: feed folders to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from tiers.operators.counts import rows_taken
from tiers.plans.gold import gold_refresh
from tiers.plans.silver import silver_refresh
from tiers.sinks.parted import PARTS
from tiers.sinks.tables import ensure_schema
from tiers.sources.csv import load_time
from tiers.specs import SPECS, UPDATED_AT
from tiers.streaming.ingest import ingest

LAYERS = ("bronze", "silver", "gold")
LOAD_COUNTS = "load_counts"


def log_counts(spark: SparkSession, table: str, counts: list[tuple[str, str, str, int]], now=None) -> None:
    """Note how many rows a run took in, kept and rejected: a row for each feed, layer and figure."""
    rows = spark.createDataFrame(counts, "feed string, layer string, figure string, row_count bigint")
    rows.withColumn(UPDATED_AT, load_time(now)).coalesce(1).write.mode("append").saveAsTable(table)


def run(
    spark: SparkSession,
    folders: dict[str, str],
    checkpoint_root: str,
    prefix: str = "",
    location: str | None = None,
    now=None,
    since=None,
    buckets: int | None = None,
    consumer_id_type: str = "string",
    incremental: bool = True,
    parts: int = PARTS,
) -> str:
    """Take in what has arrived and refresh every table; returns the name of the gold table.

    What each feed brought is noted in the table `load_counts` beside the silver tables.

    ``prefix`` goes in front of the schema names bronze, silver and gold; ``location`` is the folder for
    them where the warehouse folder is not to be used. Silver goes on from the load times it holds and gold from
    the changes it has seen, unless ``incremental`` is false; load times must not fall from run to run then.
    ``parts`` is for tables still to be made: with more of them a small delivery rewrites less.
    """
    bronze, silver, gold = (f"{prefix}{layer}" for layer in LAYERS)
    for schema in (bronze, silver, gold):
        ensure_schema(spark, schema, f"{location}/{schema}" if location else None)

    def refresh(name: str) -> list[tuple[str, str, str, int]]:
        raw, clean = f"{bronze}.{name}", f"{silver}.{name}"
        taken = rows_taken(ingest(spark, SPECS[name], folders[name], raw, checkpoint_root, now))
        counts = silver_refresh(spark, SPECS[name], raw, clean, f"{clean}_rejects", now, since, buckets, incremental, parts)
        return [(name, "bronze", "rows_in", taken), *[(name, "silver", figure, n) for figure, n in counts.items()]]

    # The feeds do not depend on each other, so their jobs share the cluster.
    with ThreadPoolExecutor(len(folders)) as pool:
        counts = [row for rows in pool.map(inheritable_thread_target(spark)(refresh), folders) for row in rows]
    log_counts(spark, f"{silver}.{LOAD_COUNTS}", counts, now)
    tables = {name: f"{silver}.{name}" for name in SPECS}
    gold_refresh(spark, tables, f"{gold}.output", now, consumer_id_type, incremental, parts)
    return f"{gold}.output"
