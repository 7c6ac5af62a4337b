"""Stand-ins for the four bronze feeds, derived from the sample tables.

The dirt (missing keys, unreadable values, repeated keys) is injected by arithmetic on the keys, so that a
SQL engine can derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.specs import LOAD_TIMESTAMP, RAW_FILE_NAME

FIRST_LOAD = "2024-01-01 00:00:00"


_schemas: dict[str, T.StructType] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A sample table; its schema is looked up in the file once per process."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _text(column: Column) -> Column:
    return column.cast("string")


def _unless(condition: Column, value: Column, instead: str | None = None) -> Column:
    """The value, but for rows meeting the condition the replacement (NULL by default)."""
    return F.when(condition, F.lit(instead)).otherwise(value)


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def _buyer(column: str) -> Column:
    """A consumer id, some of which are no numbers."""
    return F.when(_every(column, 89), F.concat(F.lit("C-"), F.col(column))).otherwise(_text(F.col(column)))


def _audit(file_name: str, loaded: Column) -> list[Column]:
    return [F.lit(file_name).alias(RAW_FILE_NAME), loaded.cast("timestamp").alias(LOAD_TIMESTAMP)]


def consumer(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    age = F.when(_every("c_custkey", 41), "unknown").otherwise(
        _unless(_every("c_custkey", 37), _text(18 + key % 60))
    )
    return _table(spark, folder, "customer").select(
        _unless(_every("c_custkey", 97), _buyer("c_custkey")).alias("consumerid"),
        F.when(_every("c_custkey", 2), "F").otherwise("M").alias("sex"),
        F.col("c_mktsegment").alias("ethnicity"),
        _text(F.col("c_nationkey")).alias("race"),
        age.alias("age"),
        *_audit("customer.parquet", F.lit(FIRST_LOAD)),
    )


def purchase(spark: SparkSession, folder: str) -> DataFrame:
    key, buyer = F.col("o_orderkey"), F.col("o_custkey")
    return _table(spark, folder, "orders").select(
        _unless(_every("o_orderkey", 211), _text(key)).alias("purchaseid"),
        _unless(_every("o_orderkey", 101), _buyer("o_custkey")).alias("consumerid"),
        _text(F.to_date("o_orderdate")).alias("graphed_date"),
        _text(key % 1000).alias("avocado_bunch_id"),
        _unless(_every("o_orderkey", 53), _text(F.year("o_orderdate")), "n/a").alias("reporting_year"),
        F.col("o_orderpriority").alias("qa_process"),
        _text(key * 7).alias("billing_provider_sku"),
        _text(buyer % 25).alias("grocery_store_id"),
        _unless(_every("o_orderkey", 29), _text(key % 11)).alias("price_index"),
        *_audit("orders.parquet", F.lit(FIRST_LOAD)),
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    lineitem, orders = _table(spark, folder, "lineitem"), _table(spark, folder, "orders")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def avocado(spark: SparkSession, folder: str) -> DataFrame:
    shipped = F.to_date("l_shipdate")
    return _lines(spark, folder).select(
        _unless(_every("l_orderkey", 103), _buyer("o_custkey")).alias("consumerid"),
        _text(F.col("l_orderkey")).alias("purchaseid"),
        _text(F.col("l_suppkey")).alias("avocado_bunch_id"),
        _text(F.col("l_partkey")).alias("plu"),
        _unless(_every("l_orderkey", 59), _text(F.col("l_linenumber")), "ripe").alias("ripe_index_when_picked"),
        _text(F.to_date("o_orderdate")).alias("born_date"),
        _text(shipped).alias("picked_date"),
        _text(F.date_add(shipped, F.col("l_quantity").cast("int") - 10)).alias("sold_date"),
        *_audit("lineitem.parquet", F.col("l_shipdate")),
    )


def fertilizer(spark: SparkSession, folder: str) -> DataFrame:
    part = _table(spark, folder, "part")
    size = _text(F.col("p_size"))
    mg = (
        F.when(_every("l_partkey", 3), F.lit(None))
        .when(_every("l_partkey", 31), "5mg")
        .when(_every("l_partkey", 37), F.concat(F.lit(" "), size, F.lit("  ")))
        .when(_every("l_partkey", 41), F.concat(size, F.lit(".75")))
        .when(_every("l_partkey", 43), "99999999999")
        .when(_every("l_partkey", 47), "NaN")
        .otherwise(size)
    )
    return _lines(spark, folder).join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        _unless(_every("l_orderkey", 107), _text(F.col("l_orderkey"))).alias("purchaseid"),
        _buyer("o_custkey").alias("consumerid"),
        _text(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("fertilizerid"),
        F.col("p_type").alias("type"),
        mg.alias("mg"),
        F.col("l_returnflag").alias("frequency"),
        *_audit("lineitem.parquet", F.col("l_shipdate")),
    )


FEEDS = {"avocado": avocado, "consumer": consumer, "fertilizer": fertilizer, "purchase": purchase}


def feed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return FEEDS[name](spark, folder)
