"""Declarative description of the four feeds and of the output tables.

Everything else in the package is generic code over an ``EntitySpec``; adding a feed means adding a spec.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

RAW_FILE_NAME = "raw_file_name"
LOAD_TIMESTAMP = "load_timestamp"
UPDATED_AT = "updated_at"
AUDIT_FIELDS = (
    T.StructField(RAW_FILE_NAME, T.StringType()),
    T.StructField(LOAD_TIMESTAMP, T.TimestampType()),
)

TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "date": T.DateType()}


@dataclass(frozen=True)
class Column:
    """One business column: canonical name, silver type, and the header it has in the raw feed."""

    name: str
    type: str
    header: str | None = None

    @property
    def raw(self) -> str:
        return self.header or self.name


@dataclass(frozen=True)
class EntitySpec:
    name: str
    columns: tuple[Column, ...]
    feed_order: tuple[str, ...]
    primary_key: tuple[str, ...]
    required: tuple[str, ...]
    merge_key: tuple[str, ...]
    unused_in_analysis: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def in_feed_order(self) -> list[Column]:
        by_name = {c.name: c for c in self.columns}
        return [by_name[name] for name in self.feed_order]

    @property
    def raw_schema(self) -> T.StructType:
        """The CSV file as delivered: raw headers, everything text."""
        return T.StructType([T.StructField(c.raw, T.StringType()) for c in self.in_feed_order])

    @property
    def bronze_schema(self) -> T.StructType:
        fields = [T.StructField(c.name, T.StringType()) for c in self.in_feed_order]
        return T.StructType([*fields, *AUDIT_FIELDS])

    @property
    def typed_schema(self) -> T.StructType:
        """Business columns with their silver types, plus the bronze audit columns."""
        fields = [T.StructField(c.name, TYPES[c.type]) for c in self.columns]
        return T.StructType([*fields, *AUDIT_FIELDS])

    @property
    def silver_schema(self) -> T.StructType:
        return T.StructType([*self.typed_schema.fields, T.StructField(UPDATED_AT, T.TimestampType())])

    @property
    def tie_breakers(self) -> list[str]:
        """Columns which decide between rows of one key loaded at the same time."""
        return [c for c in self.names if c not in self.primary_key] + [RAW_FILE_NAME]


# Column names, header spellings, types and keys of the feeds.
AVOCADO = EntitySpec(
    name="avocado",
    columns=(
        Column("purchaseid", "bigint"),
        Column("consumerid", "string"),
        Column("avocado_bunch_id", "int"),
        Column("plu", "bigint"),
        Column("ripe_index_when_picked", "int", "ripe index when picked"),
        Column("born_date", "date"),
        Column("picked_date", "date"),
        Column("sold_date", "date"),
    ),
    feed_order=(
        "consumerid",
        "purchaseid",
        "avocado_bunch_id",
        "plu",
        "ripe_index_when_picked",
        "born_date",
        "picked_date",
        "sold_date",
    ),
    primary_key=("purchaseid",),
    required=("purchaseid", "consumerid"),
    merge_key=("purchaseid",),
)
CONSUMER = EntitySpec(
    name="consumer",
    columns=(
        Column("consumerid", "string"),
        Column("sex", "string"),
        Column("ethnicity", "string"),
        Column("race", "string"),
        Column("age", "int"),
    ),
    feed_order=("consumerid", "sex", "ethnicity", "race", "age"),
    primary_key=("consumerid",),
    required=("consumerid",),
    merge_key=("consumerid",),
)
FERTILIZER = EntitySpec(
    name="fertilizer",
    columns=(
        Column("purchaseid", "bigint"),
        Column("consumerid", "string"),
        Column("fertilizerid", "bigint"),
        Column("type", "string"),
        Column("mg", "int"),
        Column("frequency", "string"),
    ),
    feed_order=("purchaseid", "consumerid", "fertilizerid", "type", "mg", "frequency"),
    primary_key=("fertilizerid",),
    required=("purchaseid", "consumerid", "fertilizerid"),
    merge_key=("fertilizerid",),
    unused_in_analysis=("frequency",),
)
PURCHASE = EntitySpec(
    name="purchase",
    columns=(
        Column("purchaseid", "bigint"),
        Column("consumerid", "string"),
        Column("graphed_date", "date"),
        Column("avocado_bunch_id", "int"),
        Column("reporting_year", "int"),
        Column("qa_process", "string", "QA process"),
        Column("billing_provider_sku", "bigint"),
        Column("grocery_store_id", "int"),
        Column("price_index", "int"),
    ),
    feed_order=(
        "purchaseid",
        "consumerid",
        "graphed_date",
        "avocado_bunch_id",
        "reporting_year",
        "qa_process",
        "billing_provider_sku",
        "grocery_store_id",
        "price_index",
    ),
    primary_key=("purchaseid",),
    required=("purchaseid", "consumerid"),
    merge_key=("purchaseid",),
)
SPECS = {spec.name: spec for spec in (AVOCADO, CONSUMER, FERTILIZER, PURCHASE)}


def gold_schema(consumer_id_type: str = "string") -> T.StructType:
    """Final output; the consumer id is text unless the caller asks for a number."""
    fields = [
        ("consumer_id", TYPES[consumer_id_type]),
        ("sex", T.StringType()),
        ("age", T.IntegerType()),
        ("avocado_days_sold", T.IntegerType()),
        ("avocado_ripe_index", T.IntegerType()),
        ("avocado_days_picked", T.IntegerType()),
        ("fertilizer_type", T.StringType()),
        (UPDATED_AT, T.TimestampType()),
    ]
    return T.StructType([T.StructField(name, kind) for name, kind in fields])
