"""CSV feeds: strict batch readers and the columns saying where a row came from."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.functions.names import normalize_names, rename_feed
from tiers.specs import LOAD_TIMESTAMP, RAW_FILE_NAME, EntitySpec


def load_time(now=None) -> Column:
    """The time of the run; pass a fixed one to make a load repeatable."""
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")


def with_metadata(df: DataFrame, file_name: str | Column, now=None) -> DataFrame:
    """Add the source file name and the load time."""
    name = file_name if isinstance(file_name, Column) else F.lit(file_name)
    return df.withColumns({RAW_FILE_NAME: name, LOAD_TIMESTAMP: load_time(now)})


def scan_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header names as found, every column text, like any plain CSV scan."""
    return spark.read.option("header", True).csv(path)


def read_feed(spark: SparkSession, spec: EntitySpec, path: str | list[str], now=None) -> DataFrame:
    """One feed as bronze rows.

    The schema comes from the spec, so no job runs to find it, and the headers of all files are checked
    against it while they are read: Spark binds CSV columns by position, and a moved column would
    otherwise fill the wrong one silently.
    """
    raw = spark.read.schema(spec.raw_schema).option("header", True).option("enforceSchema", False).csv(path)
    return rename_feed(raw, spec, _file_path(), load_time(now).alias(LOAD_TIMESTAMP))


def _file_path() -> Column:
    return F.col("_metadata.file_path").alias(RAW_FILE_NAME)


def read_drops(spark: SparkSession, drops: Iterable[str], now=None) -> DataFrame:
    """Deliveries (files or folders) whose headers may differ, matched by column name.

    One header line is read per drop; drops with equal headers become one scan, and a scan fails if a file
    inside it has another header. Columns a drop lacks are NULL.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for drop in drops:
        by_header.setdefault(tuple(scan_text(spark, drop).columns), []).append(drop)
    frames = []
    for header, paths in by_header.items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        raw = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(paths)
        named = normalize_names(raw.select("*", _file_path()))
        frames.append(with_metadata(named, F.col(RAW_FILE_NAME), now))
    if not frames:
        raise ValueError("no drops to read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

