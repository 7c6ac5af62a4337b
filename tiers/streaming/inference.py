"""Types of text columns nobody has described, from one aggregate over just those columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How a CSV reader expects values of each type, the narrowest type first.
_KINDS = (
    (T.IntegerType(), r"^[+-]?[0-9]+$"),
    (T.LongType(), r"^[+-]?[0-9]+$"),
    (T.DoubleType(), r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"),
    (T.DateType(), r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    (T.TimestampType(), r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?$"),
    (T.BooleanType(), r"^(?i)(true|false)$"),
)


def inferred(texts: DataFrame, columns: Sequence[str]) -> dict[str, T.DataType]:
    """For each column the narrowest type all its values have; text if it has none. Other columns are not looked at."""
    if not columns:
        return {}
    counts = []
    for i, name in enumerate(columns):
        value = F.col(f"`{name}`")
        counts.append(F.count(value).alias(f"filled_{i}"))
        for j, (kind, pattern) in enumerate(_KINDS):
            # Conversions cost an exception where they fail, so the pattern comes first.
            fits = F.when(value.rlike(pattern), value.try_cast(kind))
            counts.append(F.count(fits).alias(f"fits_{i}_{j}"))
    found = texts.agg(*counts).first()
    out: dict[str, T.DataType] = {}
    for i, name in enumerate(columns):
        fitting = [kind for j, (kind, _) in enumerate(_KINDS) if found[f"fits_{i}_{j}"] == found[f"filled_{i}"] > 0]
        out[name] = fitting[0] if fitting else T.StringType()
    return out
