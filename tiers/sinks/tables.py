"""Managed Parquet tables: creation, upsert, replace-by-key and idempotent reject logs.

Parquet tables have no MERGE. A change therefore builds a complete successor next to the table and swaps
the two by renaming. Each table is expected to have one writer at a time; between the two renames the
table is briefly absent, and ``recover`` puts the old version back if the driver died exactly there.

With ``buckets`` the table is stored hash-bucketed by its key: the next upsert then joins the old version
without moving it, and joins on the key read the buckets in place. With ``parts`` (`tiers.sinks.parted`) a
change rewrites only the parts its keys fall into, and no reader finds the table absent; a table keeps the
layout it was created with.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.operators.quality import REJECT_ID
from tiers.sinks import parted
from tiers.specs import LOAD_TIMESTAMP


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def ensure_table(spark: SparkSession, table: str, schema: T.StructType) -> bool:
    """Create an empty table with the schema; true if it was missing."""
    if spark.catalog.tableExists(table):
        return False
    spark.catalog.createTable(table, schema=schema, source="parquet")
    return True


def add_missing_columns(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Widen a table by the columns it lacks; rows already there read NULL in them."""
    present = set(spark.table(table).columns)
    new = [f for f in schema if f.name not in present]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def create_from(df: DataFrame, table: str, keys: Sequence[str] = (), buckets: int | None = None) -> None:
    """First write of a table, bucketed by its key if asked for (one file per bucket)."""
    if buckets:
        df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).saveAsTable(table)
    else:
        df.write.saveAsTable(table)


def recover(spark: SparkSession, table: str) -> None:
    """Bring back the previous version if a swap was cut short, and clear the unfinished successor."""
    schema, _, name = table.rpartition(".")
    old = f"{table}__old"
    if spark.catalog.tableExists(old) and not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    within = f" IN {schema}" if schema else ""
    for leftover in spark.sql(f"SHOW TABLES{within} LIKE '{name}__fresh_*'").collect():
        spark.sql(f"DROP TABLE {schema + '.' if schema else ''}{leftover['tableName']}")


def refuse_repeated_keys(df: DataFrame, keys: Sequence[str]) -> None:
    # NULL keys match nothing, so several rows may have them.
    repeated = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).take(1)
    if repeated:
        raise ValueError(f"source holds several rows for one key, e.g. {repeated[0].asDict()}")


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the schema by name; NULL in those the frame lacks."""
    return df.select(*[F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def _merge(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    buckets: int | None,
    unique: bool,
    check: bool,
    newer: str | None = None,
) -> None:
    """Write the source as the successor, add the old rows it does not replace, and swap.

    With ``unique`` keys NULL matches nothing, otherwise it is a key like any other. A new column in the
    source widens the table; a source that lacks one is refused before anything is written.
    """
    recover(spark, table)
    if spark.catalog.tableExists(table):
        lacking = [c for c in spark.table(table).columns if c not in source.columns]
        if lacking:
            raise ValueError(f"source lacks columns of {table}: {', '.join(lacking)}")
    fresh, old = f"{table}__fresh_{uuid.uuid4().hex[:8]}", f"{table}__old"
    exists = spark.catalog.tableExists(table)
    if newer and exists:
        source = _without_late_rows(source, spark.table(table), keys, newer)
    # The source is computed once, straight into the successor; everything below reads it from there.
    create_from(source, fresh, keys, buckets)
    if check:
        try:
            refuse_repeated_keys(spark.table(fresh), keys)
        except ValueError:
            spark.sql(f"DROP TABLE {fresh}")
            raise
    if not exists:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        return
    target = spark.table(table)
    arrived = spark.table(fresh).select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    if not unique:
        arrived = arrived.distinct()
    pairs = [(F.col(k), F.col(f"_new_{k}")) for k in keys]
    match = reduce(and_, [a == b if unique else a.eqNullSafe(b) for a, b in pairs])
    kept = target.join(arrived, match, "left_anti")
    aligned(kept, spark.table(fresh).schema).write.insertInto(fresh)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")


def _without_late_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], newer: str) -> DataFrame:
    old = target.select(*[F.col(k).alias(f"_old_{k}") for k in keys], F.col(newer).alias("_version"))
    same = reduce(and_, [F.col(k) == F.col(f"_old_{k}") for k in keys])
    return source.join(old, same & ~parted.not_older(F.col(newer), F.col("_version")), "left_anti")


def upsert(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    buckets: int | None = None,
    known_unique: bool = False,
    parts: int | None = None,
    newer: str | None = None,
    track: Sequence[str] = (),
    at: Column | None = None,
) -> None:
    """Rows with a known key replace the old row, others are added; the first call creates the table.

    Refuses a source with several rows for one key, leaving the table as it was; a source deduplicated by
    the same key can skip the check. NULL keys match nothing, so such rows are added each time. ``newer``
    names a column: a row does not replace one with a later value in it (NULL is earlier than any value).
    A table with ``parts`` notes the values of the ``track`` columns in changed rows, old and new, with the
    time ``at`` (see `parted.changes_of`).
    """
    if parts or parted.is_parted(spark, table):
        check = None if known_unique else lambda rows: refuse_repeated_keys(rows, keys)
        parted.merge(spark, table, source, keys, parts, True, check, newer, track, at)
        return
    _merge(spark, table, source, keys, buckets, unique=True, check=not known_unique, newer=newer)


def replace_by_key(
    spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str], parts: int | None = None
) -> None:
    """All old rows of the keys in the source go, all rows of the source come: for keys with many rows."""
    if parts or parted.is_parted(spark, table):
        parted.merge(spark, table, source, keys, parts, unique=False)
        return
    _merge(spark, table, source, keys, None, unique=False, check=False)


LOAD_MONTH = "load_month"


def append_rejects(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Append the rejects not logged yet; seeing the same bronze rows again adds nothing.

    A log of rows with a load time is partitioned by its month (few files, however many days a first load spans), and
    only the months and days at hand are looked through. New columns widen the log; in columns that the rows lack they
    are logged as NULL.
    """
    if LOAD_TIMESTAMP in rows.columns:
        rows = rows.withColumn(LOAD_MONTH, F.trunc(LOAD_TIMESTAMP, "month"))
    by_month = [LOAD_MONTH] if LOAD_MONTH in rows.columns else []
    if by_month:
        rows = rows.hint("rebalance", LOAD_MONTH)
    if not spark.catalog.tableExists(table):
        rows.write.partitionBy(*by_month).saveAsTable(table)
        return
    add_missing_columns(spark, table, rows.schema)
    stage = f"{table}__fresh_{uuid.uuid4().hex[:8]}"
    rows.write.saveAsTable(stage)
    new = new_rejects(spark.table(stage), spark.table(table))
    aligned(new, spark.table(table).schema).write.insertInto(table)
    spark.sql(f"DROP TABLE {stage}")


def new_rejects(rows: DataFrame, logged: DataFrame) -> DataFrame:
    """The rows that the log does not hold; it is read in the load months of the rows, from their first to their last day."""
    if LOAD_MONTH in rows.columns and LOAD_MONTH in logged.columns:
        loaded = F.col(LOAD_TIMESTAMP)
        spans = rows.groupBy(LOAD_MONTH).agg(F.min(loaded).alias("first"), F.max(loaded).alias("last")).collect()
        months = [r[LOAD_MONTH] for r in spans if r[LOAD_MONTH] is not None]
        held = F.lit(False)
        if months:
            first, last = min(r["first"] for r in spans if r["first"]), max(r["last"] for r in spans if r["last"])
            held = F.col(LOAD_MONTH).isin(months) & loaded.between(F.lit(first), F.lit(last))
        unknown = len(months) < len(spans)
        logged = logged.where(held | F.col(LOAD_MONTH).isNull() if unknown else held)
    return rows.join(logged.select(REJECT_ID), REJECT_ID, "left_anti")
