"""Row-level rules: latest row per key, required columns, rejects and date rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiers.specs import LOAD_TIMESTAMP

ERROR_REASON = "error_reason"
REJECT_ID = "reject_id"


def filled(columns: Sequence[str]) -> Column:
    """All the columns have a value."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def latest_per_key(
    df: DataFrame, keys: Sequence[str], tie_breakers: Sequence[str], keep_null_keys: bool = False
) -> DataFrame:
    """Keep the most recently loaded row of each key.

    Rows of one load share a load time, so ties are normal: the tie-breakers (smallest value first, NULL
    last) make the choice repeatable. A frame without load times is ordered by the tie-breakers alone. NULL
    keys are dropped before the shuffle unless asked for, when they form one group. Spark limits every group
    to one row per map task ahead of the exchange, so a key with a third of all rows arrives as a handful.
    """
    order = [F.asc_nulls_last(c) for c in tie_breakers]
    if LOAD_TIMESTAMP in df.columns:
        order.insert(0, F.desc_nulls_last(LOAD_TIMESTAMP))
    rows = df if keep_null_keys else df.filter(filled(keys))
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_position", position).filter(F.col("_position") == 1).drop("_position")


def required_ok(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows with a value in every required column.

    Runs after the deduplication: if the latest row of a key lacks a required value, the key disappears
    instead of falling back to an older row.
    """
    return df.filter(filled(required))


def rejects(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The complement of ``required_ok``, with the names of the empty columns as the reason."""
    empty = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    reason = F.concat(F.lit("missing or unreadable: "), F.concat_ws(", ", *empty))
    return df.filter(~filled(required)).withColumn(ERROR_REASON, reason)


def row_id(columns: Sequence[str]) -> Column:
    """A 256-bit content hash; NULL and empty text give different ids, as do shifted values."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def date_order(avocado: DataFrame) -> DataFrame:
    """Born before picked before sold; rows lacking a date go."""
    return avocado.filter((F.col("picked_date") > F.col("born_date")) & (F.col("sold_date") > F.col("picked_date")))


def positive_durations(df: DataFrame) -> DataFrame:
    """Sold after birth and after picking; unlike ``date_order`` picked may precede born."""
    return df.filter((F.col("avocado_days_sold") > 0) & (F.col("avocado_days_picked") > 0))
