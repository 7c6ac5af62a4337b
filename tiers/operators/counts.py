"""Row counts that a write takes along, without a job of their own."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

STREAM = "rows_taken"


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and where the number of its rows will be once it has been written.

    A frame that is run twice is counted the first time; a task that is run again may be counted again.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def rows_seen(seen: Observation) -> int:
    try:
        return seen.get["rows"]
    except (KeyError, Py4JJavaError):
        return 0  # the optimizer knew that there are no rows, and took the whole branch away


def counted_stream(df: DataFrame) -> DataFrame:
    return df.observe(STREAM, F.count(F.lit(1)).alias("rows"))


def rows_taken(query: StreamingQuery) -> int:
    """Rows that a finished stream of `counted_stream` has taken in, as far back as its progress is kept."""
    batches = [p.observedMetrics.get(STREAM) for p in query.recentProgress]
    return sum(b["rows"] for b in batches if b is not None)
