"""Bronze to silver: validate, deduplicate, split off the rejects, upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.functions.casts import align, typed, validate
from tiers.operators.counts import counted, rows_seen
from tiers.operators.quality import REJECT_ID, latest_per_key, rejects, required_ok, row_id
from tiers.session import tune
from tiers.sinks.parted import PARTS
from tiers.sinks.tables import append_rejects, upsert
from tiers.sources.csv import load_time
from tiers.specs import LOAD_TIMESTAMP, UPDATED_AT, EntitySpec

#: What a change in any silver table is noted by: the gold output is one set of rows for each consumer.
TRACKED = ("consumerid",)


def clean_rows(bronze: DataFrame, spec: EntitySpec) -> DataFrame:
    """Typed, latest per key, complete: the silver rows without the time of the update.

    Only the key is converted before the shuffle; the other columns are converted in the rows that remain.
    """
    keys = {f.name: f.dataType for f in spec.typed_schema if f.name in spec.primary_key}
    keyed = bronze.withColumns({name: typed(F.col(name), kind) for name, kind in keys.items()})
    latest = latest_per_key(keyed, spec.primary_key, spec.tie_breakers)
    return required_ok(align(latest, spec.typed_schema), spec.required)


def rejected_rows(bronze: DataFrame, spec: EntitySpec) -> DataFrame:
    """All bronze rows lacking a required value, typed values and original texts side by side."""
    marked = bronze.withColumn(REJECT_ID, row_id(bronze.columns))
    return rejects(validate(marked, spec.typed_schema, keep=[REJECT_ID]), spec.required)


def last_load(spark: SparkSession, table: str) -> int | None:
    """Latest load time in a table, in microseconds since 1970; NULL if there is none."""
    if not spark.catalog.tableExists(table):
        return None
    return spark.table(table).agg(F.unix_micros(F.max(LOAD_TIMESTAMP))).first()[0]


def loaded_from(bronze: DataFrame, micros: int | None) -> DataFrame:
    """Rows loaded at that time or later, or at an unknown time."""
    if micros is None:
        return bronze
    loaded = F.col(LOAD_TIMESTAMP)
    return bronze.filter((loaded >= F.timestamp_micros(F.lit(micros))) | loaded.isNull())


def silver_refresh(
    spark: SparkSession,
    spec: EntitySpec,
    bronze_table: str,
    silver_table: str,
    reject_table: str,
    now=None,
    since=None,
    buckets: int | None = None,
    incremental: bool = False,
    parts: int = PARTS,
) -> dict[str, int]:
    """Bring one silver table and its reject log up to date with bronze.

    A row replaces the one silver has for its key only if it was not loaded earlier, so deliveries may come late,
    again or in any order. Silver lies in parts and notes the consumers of the rows that change, for the gold refresh;
    with ``buckets`` it is a plain bucketed table that each refresh rewrites.

    Reads all of bronze, or only rows loaded after ``since``; given growing load times both end in the
    same silver rows. ``incremental`` goes on, for either table by itself, from the latest load time that
    it holds, that time included: what a run that broke off had not written yet is read again. A delivery older than
    that has to be read by a refresh that is not incremental. Clean and rejected rows come from two scans on
    purpose: the second is a filter with no shuffle, which costs less than caching a bronze table would.

    Returns how many bronze rows were read for silver, how many of them were kept and how many rows were rejected,
    logged before or not; the writes count them on the way.
    """
    tune(spark)
    bronze = spark.table(bronze_table)
    if since is not None:
        bronze = bronze.filter(F.col(LOAD_TIMESTAMP) > F.lit(since).cast("timestamp"))
    stamp = load_time(now)
    fresh, failed = bronze, bronze
    if incremental:
        fresh, failed = (loaded_from(bronze, last_load(spark, table)) for table in (silver_table, reject_table))
    fresh, came = counted(fresh)
    clean, kept = counted(clean_rows(fresh, spec).withColumn(UPDATED_AT, stamp))
    deduplicated = set(spec.primary_key) <= set(spec.merge_key)
    layout = {"buckets": buckets} if buckets else {"parts": parts, "track": TRACKED, "at": stamp}
    upsert(spark, silver_table, clean, spec.merge_key, known_unique=deduplicated, newer=LOAD_TIMESTAMP, **layout)
    bad, rejected = counted(rejected_rows(failed, spec).withColumn(UPDATED_AT, stamp))
    append_rejects(spark, reject_table, bad)
    return {"rows_in": rows_seen(came), "kept": rows_seen(kept), "rejected": rows_seen(rejected)}
