"""Tables kept in parts, so that a change reads and rewrites only the parts it touches.

The rows of table ``t`` lie in ``t__store``, partitioned by a hash of the key (``_part``); ``t`` itself is a view of its
other columns. An upsert

1. writes the source once, with the part of each row, to a staging table;
2. looks the staged keys up in the parts they fall into (partition pruning, key columns only). Parts without a known key
   need no rewriting: their new rows are appended as further files;
3. writes the successors of the other parts next to the store, and replaces them by a dynamic partition overwrite.

The files of all other parts stay as they are. A table has one writer at a time. If the driver dies before step 3 is
written, the store is untouched; if it dies later the next write repeats the overwrite from the finished successors
(``recover``), and repeating the upsert brings what had not been appended. Rows with an unknown key are dealt over all parts.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "_part"
PARTS = 16
CHANGED_AT = "changed_at"
CHANGE_DAY = "change_day"
_DYNAMIC = ("partitionOverwriteMode", "dynamic")
_PROPERTIES = ("tiers.keys", "tiers.parts")


def store_of(table: str) -> str:
    return f"{table}__store"


def changes_of(table: str) -> str:
    return f"{table}__changes"


def layout(spark: SparkSession, table: str) -> tuple[list[str], int] | None:
    """Key columns and number of parts of a table; None if it has no (finished) store."""
    if not spark.catalog.tableExists(store_of(table)):
        return None
    rows = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {store_of(table)}").collect()}
    if _PROPERTIES[0] not in rows:
        return None
    return rows[_PROPERTIES[0]].split(","), int(rows[_PROPERTIES[1]])


def is_parted(spark: SparkSession, table: str) -> bool:
    return layout(spark, table) is not None


def part_of(df: DataFrame, keys: Sequence[str], parts: int, unique: bool) -> Column:
    """The part of a row. Where NULL matches nothing, rows with a NULL key may lie anywhere."""
    place = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    if unique:
        unknown = reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])
        place = F.when(unknown, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).otherwise(place)
    return F.pmod(place, F.lit(parts)).cast("int")


def _save(df: DataFrame, table: str) -> None:
    """Rows of a part go to as many files as they need, few if they are few."""
    df.hint("rebalance", PART).write.partitionBy(PART).option(*_DYNAMIC).saveAsTable(table)


def _leftovers(spark: SparkSession, table: str, kind: str) -> list[str]:
    schema, _, name = table.rpartition(".")
    within = f" IN {schema}" if schema else ""
    found = spark.sql(f"SHOW TABLES{within} LIKE '{name}__{kind}_*'").collect()
    return [f"{schema + '.' if schema else ''}{r['tableName']}" for r in found]


def recover(spark: SparkSession, table: str) -> None:
    """Finish what was cut short: a replacement from finished successors, a store that is not shown yet; clear the rest."""
    if is_parted(spark, table):
        for ready in _leftovers(spark, table, "next"):
            # A table is registered once it is completely written.
            _replace(spark, table, ready)
        if not spark.catalog.tableExists(table) or spark.catalog.getTable(table).tableType != "VIEW":
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            _show(spark, table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {store_of(table)}")
    for kind in ("next", "stage"):
        for unfinished in _leftovers(spark, table, kind):
            spark.sql(f"DROP TABLE {unfinished}")


def _replace(spark: SparkSession, table: str, ready: str) -> None:
    store = spark.table(store_of(table))
    spark.table(ready).select(*store.columns).write.mode("overwrite").insertInto(store_of(table))


def _show(spark: SparkSession, table: str) -> None:
    columns = ", ".join(f"`{c}`" for c in spark.table(store_of(table)).columns if c != PART)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {columns} FROM {store_of(table)}")


def _finish(spark: SparkSession, table: str, keys: Sequence[str], parts: int) -> None:
    """Mark a written store as complete; from here on it holds the table."""
    values = ", ".join(f"'{k}' = '{v}'" for k, v in zip(_PROPERTIES, (",".join(keys), parts), strict=True))
    spark.sql(f"ALTER TABLE {store_of(table)} SET TBLPROPERTIES ({values})")


def adopt(spark: SparkSession, table: str, keys: Sequence[str], parts: int, unique: bool) -> None:
    """Turn a table without parts into one with parts; until its rows are copied the table stays as it is."""
    rows = spark.table(table)
    _save(rows.withColumn(PART, part_of(rows, keys, parts, unique)), store_of(table))
    _finish(spark, table, keys, parts)
    recover(spark, table)


def _same(keys: Sequence[str], unique: bool, prefix: str) -> Column:
    pairs = [(F.col(f"`{k}`"), F.col(f"`{prefix}{k}`")) for k in keys]
    return reduce(and_, [a == b if unique else a.eqNullSafe(b) for a, b in pairs])


def not_older(new: Column, old: Column) -> Column:
    """Whether a version may replace another one; an unknown version is older than any known one."""
    return F.coalesce(new >= old, old.isNull())


def winners(staged: DataFrame, target: DataFrame, keys: Sequence[str], unique: bool, newer: str | None) -> DataFrame:
    """The staged rows that go in, and whether the table knows their key (``_known``)."""
    known = target.select(*[F.col(f"`{k}`").alias(f"_old_{k}") for k in keys], *([F.col(newer).alias("_version")] if newer else []))
    if not unique:
        known = known.distinct()
    rows = staged.join(known.withColumn("_known", F.lit(True)), _same(keys, unique, "_old_"), "left")
    if newer:
        rows = rows.where(F.col("_known").isNull() | not_older(F.col(newer), F.col("_version")))
    return rows.select(*staged.columns, F.coalesce("_known", F.lit(False)).alias("_known"))


def remaining(target: DataFrame, arrived: DataFrame, keys: Sequence[str], unique: bool) -> DataFrame:
    """The rows of the table that no arriving row replaces."""
    keyed = _keys(arrived, keys)
    return target.join(keyed if unique else keyed.distinct(), _same(keys, unique, "_new_"), "left_anti")


def _keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{k}`").alias(f"_new_{k}") for k in keys])


def _only(df: DataFrame, parts: Sequence[int]) -> DataFrame:
    return df.where(F.col(PART).isin(list(parts)) if parts else F.lit(False))


def _parts_in(df: DataFrame) -> list[int]:
    """No more numbers than the table has parts."""
    return sorted(r[0] for r in df.select(PART).distinct().collect())


def log_changes(
    spark: SparkSession, table: str, old: DataFrame, new: DataFrame, columns: Sequence[str], at: Column
) -> None:
    """Note the values that changed rows have and had in some columns, each once a change."""
    log = changes_of(table)
    rows = old.select(*columns).union(new.select(*columns)).distinct().withColumn(CHANGED_AT, at)
    rows = rows.withColumn(CHANGE_DAY, F.to_date(CHANGED_AT))
    if spark.catalog.tableExists(log):
        rows.write.insertInto(log)
    else:
        rows.write.partitionBy(CHANGE_DAY).saveAsTable(log)


def merge(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    parts: int | None = None,
    unique: bool = True,
    check=None,
    newer: str | None = None,
    track: Sequence[str] = (),
    at: Column | None = None,
) -> dict[str, list[int]]:
    """Bring the source into the table; returns the numbers of the parts rewritten and of those added to.

    With ``unique`` keys NULL matches nothing, otherwise it is a key like any other and all old rows of a key make way.
    ``check`` looks at the staged rows and may raise; nothing has changed then. With ``newer`` a row only replaces one
    that has no later value in this column. ``track`` columns of old and new versions are noted in the change log with
    the time ``at``. A new column in the source widens the table, a missing one is refused.
    """
    recover(spark, table)
    exists = is_parted(spark, table)
    if not exists and spark.catalog.tableExists(table):
        adopt(spark, table, keys, parts or PARTS, unique)
        exists = True
    if not exists:
        parts, store = parts or PARTS, store_of(table)
        _save(source.withColumn(PART, part_of(source, keys, parts, unique)), store)
        _checked(spark, store, check)
        rows = spark.table(store)
        if track:
            log_changes(spark, table, rows.limit(0), rows, track, at)
        _finish(spark, table, keys, parts)
        _show(spark, table)
        return {"rewritten": [], "added": _parts_in(rows)}
    laid_out, parts = layout(spark, table)
    if not set(laid_out) <= set(keys):
        raise ValueError(f"{table} is laid out by {', '.join(laid_out)}, which the key lacks")
    lacking = [c for c in spark.table(table).columns if c not in source.columns]
    if lacking:
        raise ValueError(f"source lacks columns of {table}: {', '.join(lacking)}")
    stage = f"{table}__stage_{uuid.uuid4().hex[:8]}"
    _save(source.withColumn(PART, part_of(source, laid_out, parts, unique)), stage)
    _checked(spark, stage, check)
    widen(spark, table, spark.table(stage).schema)
    done = _apply(spark, table, spark.table(stage), keys, unique, newer, track, at)
    spark.sql(f"DROP TABLE {stage}")
    return done


def _checked(spark: SparkSession, rows: str, check) -> None:
    """Let a check see written rows; they go if it objects."""
    try:
        if check:
            check(spark.table(rows))
    except ValueError:
        spark.sql(f"DROP TABLE {rows}")
        raise


def widen(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Give the store the columns it lacks, and show them."""
    store = store_of(table)
    present = set(spark.table(store).columns)
    new = [f for f in schema if f.name not in present]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {store} ADD COLUMNS ({columns})")
        _show(spark, table)


def _apply(
    spark: SparkSession,
    table: str,
    staged: DataFrame,
    keys: Sequence[str],
    unique: bool,
    newer: str | None,
    track: Sequence[str],
    at: Column | None,
) -> dict[str, list[int]]:
    store = spark.table(store_of(table))
    stage = f"{table}__stage_{uuid.uuid4().hex[:8]}"
    _save(winners(staged, _only(store, _parts_in(staged)), keys, unique, newer), stage)
    arrived = spark.table(stage)
    known = {r[0]: r[1] for r in arrived.groupBy(PART).agg(F.max("_known")).collect()}
    rewritten, added = ([p for p in sorted(known) if known[p] == k] for k in (True, False))
    old, replacing = _only(store, rewritten), arrived.where("_known")
    if track:
        gone = old.join(_keys(replacing, keys).distinct(), _same(keys, unique, "_new_"), "left_semi")
        log_changes(spark, table, gone, arrived, track, at)
    ready = f"{table}__next_{uuid.uuid4().hex[:8]}"
    if rewritten:
        coming = _only(arrived, rewritten).select(*store.columns)
        _save(remaining(old, replacing, keys, unique).unionByName(coming), ready)
    if added:
        _only(arrived, added).select(*store.columns).write.insertInto(store_of(table))
    if rewritten:
        _replace(spark, table, ready)
        spark.sql(f"DROP TABLE {ready}")
    spark.sql(f"DROP TABLE {stage}")
    return {"rewritten": rewritten, "added": added}
