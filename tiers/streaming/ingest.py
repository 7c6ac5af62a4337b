"""Feed folder to bronze table with Structured Streaming.

The checkpoint remembers the files already read and the file sink commits each batch atomically, so
every file arrives exactly once, also across restarts. Each feed has its own checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tiers.functions.names import normal_name, rename_feed
from tiers.operators.counts import counted_stream
from tiers.sinks.tables import add_missing_columns, ensure_table
from tiers.sources.csv import load_time, scan_text
from tiers.specs import LOAD_TIMESTAMP, RAW_FILE_NAME, EntitySpec
from tiers.streaming.inference import inferred


def stream_files(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """New CSV files of a folder; a file whose header differs from the schema stops the stream."""
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder)


def found_schema(spark: SparkSession, folder: str, table: str, infer_types: bool = False) -> T.StructType:
    """Columns under the names in the header, for feeds without a spec.

    A column the table already has keeps the type it got there, so that a later run cannot read it differently. New
    ones are text, or with inferred types get the narrowest type that fits their values, which takes a pass over
    just these columns; without new columns nothing is read but a header.
    """
    found = scan_text(spark, folder)
    known = {}
    if spark.catalog.tableExists(table):
        known = {f.name: f.dataType for f in spark.table(table).schema}
    new = [c for c in found.columns if normal_name(c) not in known]
    kinds = inferred(found, new) if infer_types else dict.fromkeys(new, T.StringType())
    return T.StructType([T.StructField(c, known.get(normal_name(c)) or kinds[c]) for c in found.columns])


def write_stream(rows: DataFrame, table: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append to a table: everything there is (returning when done), or continuously at an interval."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = counted_stream(rows).writeStream.option("checkpointLocation", checkpoint).trigger(**trigger)
    query = writer.toTable(table)
    if not every:
        query.awaitTermination()
    return query


def _audit(now) -> list:
    return [F.col("_metadata.file_path").alias(RAW_FILE_NAME), load_time(now).alias(LOAD_TIMESTAMP)]


def ingest(
    spark: SparkSession,
    spec: EntitySpec,
    folder: str,
    table: str,
    checkpoint_root: str,
    now=None,
    every: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """One feed into its bronze table.

    A spec which has gained columns since the last run widens the table first; the stream then goes on
    from the same checkpoint, and earlier rows read NULL in the new columns.
    """
    if not ensure_table(spark, table, spec.bronze_schema):
        add_missing_columns(spark, table, spec.bronze_schema)
    files = stream_files(spark, folder, spec.raw_schema, files_per_batch)
    rows = rename_feed(files, spec, *_audit(now))
    return write_stream(rows, table, f"{checkpoint_root}/{spec.name}", every)


def ingest_as_found(
    spark: SparkSession,
    name: str,
    folder: str,
    table: str,
    checkpoint_root: str,
    now=None,
    every: str | None = None,
    infer_types: bool = False,
) -> StreamingQuery:
    """A feed without a spec: all its columns as found, under normalized names."""
    schema = found_schema(spark, folder, table, infer_types)
    columns = [F.col(f"`{c}`").alias(normal_name(c)) for c in schema.names]
    rows = stream_files(spark, folder, schema).select(*columns, *_audit(now))
    if not ensure_table(spark, table, rows.schema):
        add_missing_columns(spark, table, rows.schema)
    return write_stream(rows, table, f"{checkpoint_root}/{name}", every)
