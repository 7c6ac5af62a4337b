"""Column names and identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiers.specs import EntitySpec


def normal_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case, underscored column names; refuses two columns which would end up with one name."""
    names = [normal_name(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"columns collide after normalizing: {', '.join(clashes)}")
    return df.toDF(*names)


def rename_feed(df: DataFrame, spec: EntitySpec, *extra: str | Column) -> DataFrame:
    """Pick the raw columns of a feed, give them their canonical names and pass extra columns through."""
    return df.select(*[F.col(f"`{c.raw}`").alias(c.name) for c in spec.in_feed_order], *extra)


def raw_feed(bronze: DataFrame, spec: EntitySpec) -> DataFrame:
    """The inverse: bronze rows under the headers, and in the order, of the delivered file."""
    return bronze.select(*[F.col(c.name).alias(c.raw) for c in spec.in_feed_order])


def identifier(text: Column) -> Column:
    """Text made safe for use in a path or a table name."""
    return F.regexp_replace(text, "[^a-zA-Z0-9]", "_")
