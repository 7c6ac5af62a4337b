"""Silver to gold: one row per distinct combination of consumer, avocado figures and fertilizer type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.functions.casts import align
from tiers.functions.dates import day_counts
from tiers.operators.joins import Probe, spread_join
from tiers.operators.quality import positive_durations
from tiers.session import tune
from tiers.sinks import parted
from tiers.sinks.tables import replace_by_key
from tiers.sources.csv import load_time
from tiers.specs import UPDATED_AT, gold_schema

PURCHASE_KEY = ["purchaseid", "consumerid"]
FRUIT = ["avocado_days_sold", "avocado_ripe_index", "avocado_days_picked"]


def _finish(rows: DataFrame, consumer_id_type: str) -> DataFrame:
    schema = gold_schema(consumer_id_type)
    figures = type(schema)([f for f in schema if f.name != UPDATED_AT])
    return align(rows.withColumnRenamed("consumerid", "consumer_id"), figures).dropDuplicates()


def gold_output(
    avocado: DataFrame,
    consumer: DataFrame,
    fertilizer: DataFrame,
    purchase: DataFrame,
    consumer_id_type: str = "string",
    fertilizer_probe: DataFrame | None = None,
    bucketed: bool = False,
    **spread,
) -> DataFrame:
    """The output rows, without the time of the update.

    Only avocados with positive durations can contribute, so the plan starts from those and looks the
    rest up. Purchase and fertilizer share the avocado's key and join without moving it again; the
    consumer joins last, on the key by which equal output rows already lie together, so removing
    duplicates needs no further shuffle, unless avocados of a consumer with very many are split up for
    it. A consumer counts only through an existing purchase.

    Silver holds one row for each consumer, purchase and avocado, so only fertilizers can pile up under a key
    on the right; ``fertilizer_probe`` is a table that holds at least their keys and is cheaper to read. Avocados
    of one consumer are on the left, which adaptive execution splits, except against ``bucketed`` tables.
    """
    fruits = positive_durations(day_counts(avocado)).select(*PURCHASE_KEY, *FRUIT)
    bought = purchase.select(*PURCHASE_KEY, F.lit(True).alias("bought"))
    treatments = fertilizer.select(*PURCHASE_KEY, F.col("type").alias("fertilizer_type"))
    buyers = consumer.select("consumerid", "sex", "age")
    probe = treatments if fertilizer_probe is None else fertilizer_probe
    rows = fruits.join(bought, PURCHASE_KEY, "left")
    rows = spread_join(rows, treatments, PURCHASE_KEY, right_probes=[probe], **spread)
    rows = spread_join(
        rows, buyers, ["consumerid"], left_probes=[fruits], right_probes=[], split_left=bucketed, **spread
    )
    rows = rows.withColumns({c: F.when(F.col("bought"), F.col(c)) for c in ("sex", "age")})
    return _finish(rows, consumer_id_type)


def gold_output_outer_form(
    avocado: DataFrame,
    consumer: DataFrame,
    fertilizer: DataFrame,
    purchase: DataFrame,
    consumer_id_type: str = "string",
    **spread,
) -> DataFrame:
    """The same rows by the literal chain of full joins, filtered at the end; kept to compare with."""
    fruits = day_counts(avocado).select(*PURCHASE_KEY, *FRUIT)
    treatments = fertilizer.select(*PURCHASE_KEY, F.col("type").alias("fertilizer_type"))
    bought = purchase.select(*PURCHASE_KEY)
    probe = Probe(bought, ["consumerid"], PURCHASE_KEY)
    buyers = consumer.select("consumerid", "sex", "age")
    rows = spread_join(buyers, bought, ["consumerid"], "full", left_probes=[], right_probes=[probe], **spread)
    rows = spread_join(rows, fruits, PURCHASE_KEY, "full", left_probes=[probe], right_probes=[], **spread)
    rows = spread_join(rows, treatments, PURCHASE_KEY, "full", left_probes=[probe, fruits], **spread)
    return _finish(positive_durations(rows), consumer_id_type)


def gold_refresh(
    spark: SparkSession,
    silver: dict[str, str],
    gold_table: str,
    now=None,
    consumer_id_type: str = "string",
    incremental: bool = False,
    parts: int = parted.PARTS,
) -> None:
    """Bring the output up to date with the silver tables: the rows of every consumer that has any are replaced.

    ``incremental`` recomputes the consumers of silver rows that changed since the last refresh, by the change logs that
    silver tables in parts keep: the consumer a row had before and the one it has now. Both ways end in the same rows,
    but for the time of the update of consumers that did not change. The first refresh recomputes all.
    """
    tune(spark)
    stamp = load_time(now)
    frames = {name: spark.table(table) for name, table in silver.items()}
    seen = changes_until(spark, silver)
    last = refreshed_until(spark, gold_table) if incremental and seen else None
    if last:
        frames = only_consumers(frames, changed_consumers(spark, silver, last))
    bucketed = not all(parted.is_parted(spark, table) for table in silver.values())
    rows = gold_output(**frames, consumer_id_type=consumer_id_type, bucketed=bucketed).withColumn(UPDATED_AT, stamp)
    replace_by_key(spark, gold_table, rows, ["consumer_id"], parts)
    if seen:
        spark.sql(f"ALTER TABLE {parted.store_of(gold_table)} SET TBLPROPERTIES ('{REFRESHED_UNTIL}' = '{seen}')")


REFRESHED_UNTIL = "tiers.changes_until"


def changes_until(spark: SparkSession, silver: dict[str, str]) -> int | None:
    """Time of the latest noted change in microseconds since 1970; None unless all tables keep a log."""
    logs = [parted.changes_of(table) for table in silver.values()]
    if not all(spark.catalog.tableExists(log) for log in logs):
        return None
    times = [spark.table(log).agg(F.unix_micros(F.max(parted.CHANGED_AT))).first()[0] for log in logs]
    return max((t for t in times if t is not None), default=None)


def refreshed_until(spark: SparkSession, gold_table: str) -> int | None:
    """Time up to which changes are in the output."""
    if not parted.is_parted(spark, gold_table):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {parted.store_of(gold_table)}").where(F.col("key") == REFRESHED_UNTIL).collect()
    return int(rows[0]["value"]) if rows else None


def changed_consumers(spark: SparkSession, silver: dict[str, str], last: int) -> DataFrame:
    """Consumers, each once, whose rows in any table changed after that time; older days of the logs are not read."""
    since = F.timestamp_micros(F.lit(last))
    ids = [
        spark.table(parted.changes_of(table))
        .where((F.col(parted.CHANGE_DAY) >= F.to_date(since)) & (F.col(parted.CHANGED_AT) > since))
        .select("consumerid")
        for table in silver.values()
    ]
    return reduce(DataFrame.union, ids).distinct()


def only_consumers(frames: dict[str, DataFrame], consumers: DataFrame) -> dict[str, DataFrame]:
    """All tables name the consumer, and rows only meet rows of the same one: the others can be left out before the joins."""
    return {name: df.join(consumers, "consumerid", "left_semi") for name, df in frames.items()}
