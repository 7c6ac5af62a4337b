"""Derived day counts of an avocado."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_counts(avocado: DataFrame) -> DataFrame:
    """Days from birth to sale and from picking to sale, and the ripe index under its output name."""
    return avocado.withColumns(
        {
            "avocado_days_sold": F.datediff("sold_date", "born_date"),
            "avocado_days_picked": F.datediff("sold_date", "picked_date"),
        }
    ).withColumnRenamed("ripe_index_when_picked", "avocado_ripe_index")
