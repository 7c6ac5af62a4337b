"""A feed folder whose files differ in their headers, as a stream.

The stream is one of file names. Each batch looks at the headers of its files, reads the files of equal headers together
and matches columns by name, so a column that moved finds its place and a new one widens the table. A batch lies in a
partition of its own, named by stream and batch: a batch that is run again after a failure replaces what it had written.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tiers.functions.names import normal_name
from tiers.sinks.tables import add_missing_columns, aligned
from tiers.sources.csv import scan_text, with_metadata
from tiers.specs import EntitySpec
from tiers.streaming.inference import inferred

BATCH = "ingest_batch"
FILES = "path string, modificationTime timestamp, length bigint, content binary"
FILES_PER_BATCH = 1000
HEADERS_AT_ONCE = 8


def headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header; for each file its first line is read. Files without one hold nothing and are left out."""

    def look(path: str) -> tuple[str, ...]:
        return tuple(scan_text(spark, path).columns)

    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(look), paths))
    out: dict[tuple[str, ...], list[str]] = {}
    for header, path in zip(found, paths, strict=True):
        if header:
            out.setdefault(header, []).append(path)
    return out


def column_names(header: tuple[str, ...], spec: EntitySpec | None) -> list[str]:
    """The name each column of a header gets: that of the spec where it knows the header, else a normalized one."""
    known = {c.raw: c.name for c in spec.columns} if spec else {}
    names = [known.get(h, normal_name(h)) for h in header]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after normalizing: {', '.join(clashes)}")
    return names


def read_by_header(
    spark: SparkSession,
    paths: list[str],
    spec: EntitySpec | None = None,
    known: dict[str, T.DataType] | None = None,
    infer_types: bool = False,
    now=None,
) -> DataFrame | None:
    """Files of any headers below each other, matched by column name; None if none has a header.

    Columns that are known have their type; others are text, or get a type from their values.
    """
    known, frames = dict(known or {}), []
    for header, files in headers(spark, paths).items():
        names = column_names(header, spec)

        def read(kinds: dict[str, T.DataType], names=names, header=header, files=files) -> DataFrame:
            fields = [T.StructField(h, kinds.get(n, T.StringType())) for h, n in zip(header, names, strict=True)]
            reader = spark.read.schema(T.StructType(fields)).option("header", True).option("enforceSchema", False)
            raw = reader.csv(files)
            renamed = [F.col(f"`{h}`").alias(n) for h, n in zip(header, names, strict=True)]
            return raw.select(*renamed, F.col("_metadata.file_path").alias("_file"))

        if infer_types:
            new = [n for n in names if n not in known]
            known |= inferred(read({}), new)
        frames.append(read(known))
    if not frames:
        return None
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return with_metadata(rows, F.col("_file"), now).drop("_file")


def write_batch(spark: SparkSession, table: str, rows: DataFrame, batch: str) -> None:
    """The rows become the partition of the batch, whatever was in it."""
    rows = rows.withColumn(BATCH, F.lit(batch))
    if not spark.catalog.tableExists(table):
        rows.write.partitionBy(BATCH).option("partitionOverwriteMode", "dynamic").saveAsTable(table)
        return
    add_missing_columns(spark, table, rows.schema)
    aligned(rows, spark.table(table).schema).write.mode("overwrite").insertInto(table)


def ingest_drifting(
    spark: SparkSession,
    name: str,
    folder: str,
    table: str,
    checkpoint_root: str,
    now=None,
    every: str | None = None,
    spec: EntitySpec | None = None,
    infer_types: bool = False,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """New files of a folder into a table, whatever their headers: what there is now, or continuously at an interval.

    Columns lacking in a file are NULL. With ``infer_types`` a column gets its type where it first occurs and keeps it;
    a later value that does not fit is NULL, as with any typed CSV reader.
    """
    files = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", files_per_batch).load(folder)

    def take(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        # Names only: the content column is not read. All else is done in the session that sees the table later.
        paths = sorted(r["path"] for r in batch.select("path").collect())
        known = {f.name: f.dataType for f in spark.table(table).schema} if spark.catalog.tableExists(table) else {}
        rows = read_by_header(spark, paths, spec, known, infer_types, now)
        if rows is not None:
            write_batch(spark, table, rows, f"{stream}_{number}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = files.select("path").writeStream.foreachBatch(take).trigger(**trigger)
    query = writer.option("checkpointLocation", f"{checkpoint_root}/{name}").start()
    if not every:
        query.awaitTermination()
    return query
