"""Ad-hoc analysis over raw feeds: profile, clean, join and export, without managed tables."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import mul

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.functions.casts import trim_or_keep, typed_projection
from tiers.functions.dates import day_counts
from tiers.functions.names import normalize_names
from tiers.operators.joins import Probe, spread_join
from tiers.operators.profile import profile_report
from tiers.operators.quality import date_order, latest_per_key, required_ok
from tiers.session import tune
from tiers.sinks.export import export_path, export_text
from tiers.sources.csv import scan_text
from tiers.specs import AVOCADO, CONSUMER, FERTILIZER, PURCHASE, SPECS

PURCHASE_KEY = ["purchaseid", "consumerid"]


def one_fertilizer_each(fertilizer: DataFrame) -> DataFrame:
    """One row per fertilizer id, however its number is written; rows without one count as one key."""
    (key,) = FERTILIZER.primary_key
    order = [c for c in FERTILIZER.names if c != key]
    keyed = fertilizer.withColumn("_key", trim_or_keep(F.col(key)))
    return latest_per_key(keyed, ["_key"], order, keep_null_keys=True).drop("_key")


def purchase_view(
    avocado: DataFrame, consumer: DataFrame, fertilizer: DataFrame, purchase: DataFrame, **spread
) -> DataFrame:
    """Every valid purchase with its consumer, fertilizers and plausible avocados.

    Takes text feeds under canonical names. Several matches multiply rows; missing ones leave NULLs.
    """
    buyers = typed_projection(consumer, CONSUMER).select("consumerid", "sex", "age")
    fruits = day_counts(date_order(typed_projection(avocado, AVOCADO))).select(
        *PURCHASE_KEY, "avocado_days_sold", "avocado_ripe_index", "avocado_days_picked"
    )
    treatments = (
        required_ok(typed_projection(one_fertilizer_each(fertilizer), FERTILIZER), PURCHASE_KEY)
        .withColumnRenamed("type", "fertilizer_type")
        .select(*PURCHASE_KEY, "fertilizer_type")
    )
    bought = required_ok(typed_projection(purchase, PURCHASE), PURCHASE_KEY).select(*PURCHASE_KEY)
    rows = spread_join(bought, buyers, ["consumerid"], **spread)
    # Looking for frequent keys needs neither deduplicated rows nor the rules for dates.
    rows = spread_join(rows, treatments, PURCHASE_KEY, right_probes=[typed_projection(fertilizer, FERTILIZER)], **spread)
    rows = spread_join(rows, fruits, PURCHASE_KEY, right_probes=[typed_projection(avocado, AVOCADO)], **spread)
    return rows.select(
        "consumerid",
        "sex",
        "age",
        "avocado_days_sold",
        "avocado_ripe_index",
        "avocado_days_picked",
        "fertilizer_type",
    )


def explore_outer(
    avocado: DataFrame, consumer: DataFrame, fertilizer: DataFrame, purchase: DataFrame, **spread
) -> DataFrame:
    """Everything of all four uncleaned feeds side by side, matched or not.

    Columns which occur again carry the name of their feed in front.
    """
    avocado = _own_names(avocado, "avocado", purchase)
    fertilizer = _own_names(fertilizer, "fertilizer", purchase)
    bought = Probe(purchase, ["consumerid"], ["purchaseid"])
    picked, treated = Probe(avocado, ["purchaseid"]), Probe(fertilizer, ["purchaseid"])
    rows = spread_join(consumer, purchase, ["consumerid"], "full", right_probes=[bought], **spread)
    rows = spread_join(rows, avocado, ["purchaseid"], "full", left_probes=[bought], right_probes=[picked], **spread)
    return spread_join(
        rows, fertilizer, ["purchaseid"], "full", left_probes=[bought, picked], right_probes=[treated], **spread
    )


def explore_outer_counts(
    avocado: DataFrame,
    consumer: DataFrame,
    fertilizer: DataFrame,
    purchase: DataFrame,
    consumer_by: list[str],
    avocado_by: list[str],
    fertilizer_by: list[str],
    **spread,
) -> DataFrame:
    """Rows of ``explore_outer`` per purchase id and the named columns of the feeds, as ``row_count``.

    The rows are never formed: a key's rows are the product of its rows on each side, so each side is counted
    first, the counts are joined as the rows would be and multiplied. A side without the key counts once, as
    does a row whose key is NULL, which matches nothing.
    """

    def counted(df: DataFrame, columns: list[str], name: str) -> DataFrame:
        return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))

    def joined(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], probes: list[DataFrame]) -> DataFrame:
        # A side holds one row per key and value; only values of avocados can be many for a key.
        rows = spread_join(left, right, keys, "full", left_probes=[], right_probes=probes, **spread)
        product = reduce(mul, [F.coalesce(F.col(c), F.lit(1)) for c in ("_left", "_right")])
        return rows.groupBy(*columns).agg(F.sum(product).alias("_left"))

    buyers = joined(
        counted(consumer, ["consumerid", *consumer_by], "_left"),
        counted(purchase, ["consumerid", "purchaseid"], "_right"),
        ["consumerid"],
        ["purchaseid", *consumer_by],
        [],
    )
    picked = counted(avocado, ["purchaseid", *avocado_by], "_right")
    rows = joined(buyers, picked, ["purchaseid"], ["purchaseid", *consumer_by, *avocado_by], [picked])
    columns = ["purchaseid", *consumer_by, *avocado_by, *fertilizer_by]
    rows = joined(rows, counted(fertilizer, ["purchaseid", *fertilizer_by], "_right"), ["purchaseid"], columns, [])
    return rows.select(*columns, F.coalesce("_left", F.lit(0)).alias("row_count"))


def _own_names(df: DataFrame, prefix: str, taken: DataFrame) -> DataFrame:
    repeated = set(taken.columns) - {"purchaseid"}
    return df.toDF(*[f"{prefix}_{c}" if c in repeated else c for c in df.columns])


def load_feeds(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The raw feeds under normalized names."""
    return {name: normalize_names(scan_text(spark, path)) for name, path in paths.items()}


def profile_feeds(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A profile report for each feed, without its load metadata."""
    return {name: profile_report(df, SPECS[name].primary_key) for name, df in feeds.items()}


def adhoc_output(
    spark: SparkSession, paths: dict[str, str], folder: str, iteration: int = 1, day: date | None = None
) -> str:
    """Read the raw feeds, clean and join them, export the result; returns where it was written."""
    tune(spark)
    target = export_path(folder, iteration, day)
    export_text(purchase_view(**load_feeds(spark, paths)), target)
    return target
