"""Pipe-delimited text export."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

# The format of the delivered text files.
TEXT_FORMAT = {"header": True, "sep": "|", "quote": '"', "encoding": "US-ASCII", "lineSep": "\n"}


def export_path(folder: str, iteration: int, day: date | None = None) -> str:
    return f"{folder.rstrip('/')}/target_{iteration}_{day or date.today()}.csv"


def export_text(df: DataFrame, path: str) -> None:
    """Write every partition as its own file; characters outside ASCII become question marks."""
    df.write.mode("overwrite").options(**TEXT_FORMAT).csv(path)
