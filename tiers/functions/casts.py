"""Text to typed values: every conversion yields NULL on bad text and never fails the job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.specs import EntitySpec

FLAGGED_TYPES = (T.LongType, T.IntegerType, T.DateType, T.TimestampType)
WHOLE_TYPES = (T.LongType, T.IntegerType)

# Whole numbers may be padded, and may carry a fraction, which is cut off ('1.5' is 1, '.5' is 0).
_PLAIN = r"^[+-]?[0-9]+$"
_PADDING = r"[\s\p{Cntrl}]*"
_ANY_NUMBER = rf"^{_PADDING}[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+){_PADDING}$"
_WHOLE_PART = rf"^{_PADDING}([+-]?[0-9]+)"


def typed(text: Column, data_type: T.DataType) -> Column:
    """Convert a text column; NULL where the text is not a value of the type.

    A failed conversion to a number raises and catches an exception inside Spark, some twenty times the cost
    of a pattern, so only texts of the right shape are converted.
    """
    if isinstance(data_type, T.StringType):
        return text.cast(data_type)
    if not isinstance(data_type, WHOLE_TYPES):
        return text.try_cast(data_type)
    whole_part = F.regexp_extract(text, _WHOLE_PART, 1)
    return F.when(text.rlike(_PLAIN), text.try_cast(data_type)).when(
        text.rlike(_ANY_NUMBER),
        F.when(whole_part == "", F.lit(0).cast(data_type)).otherwise(whole_part.try_cast(data_type)),
    )


def trim_or_keep(text: Column) -> Column:
    """The number as text where the trimmed text is one, else the trimmed text."""
    trimmed = F.trim(text)
    return F.coalesce(typed(trimmed, T.LongType()).cast("string"), trimmed)


def typed_projection(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """The columns the analysis uses, typed; all others are dropped."""
    kept = [c for c in spec.columns if c.name not in spec.unused_in_analysis]
    schema = {f.name: f.dataType for f in spec.typed_schema}
    return df.select(*[typed(F.col(c.name), schema[c.name]).alias(c.name) for c in kept])


def _converted(df: DataFrame, field: T.StructField) -> Column:
    source = F.col(field.name)
    if isinstance(df.schema[field.name].dataType, T.StringType):
        return typed(source, field.dataType)
    return source.try_cast(field.dataType)


def validate(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Type every column and say how it went, in one projection.

    A number, date or timestamp field becomes the typed value, ``<name>_valid`` (false for NULL too) and,
    when it arrived as text, ``<name>_raw`` with the original. Other fields are converted as they are, and
    the columns to keep pass through.
    """
    columns = []
    for field in schema:
        value = _converted(df, field)
        columns.append(value.alias(field.name))
        if isinstance(field.dataType, FLAGGED_TYPES):
            columns.append(value.isNotNull().alias(f"{field.name}_valid"))
            if isinstance(df.schema[field.name].dataType, T.StringType):
                columns.append(F.col(field.name).alias(f"{field.name}_raw"))
    return df.select(*columns, *keep)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the fields of the schema, in its order and types."""
    return df.select(*[_converted(df, f).alias(f.name) for f in schema])
