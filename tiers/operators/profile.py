"""Dataset profile: all figures and duplicates of a feed from one scan.

Duplicates are counted by a content key of 128 bits, so that whole rows are not what a shuffle is keyed by; rows whose key
repeats are looked at again as they are where the count has to be exact whatever the hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that can be read as a floating point number: decimal, hexadecimal, NaN or infinite. Checked first,
# because a failed conversion costs some twenty times as much as the pattern.
_NUMBER = (
    r"^[\x00-\x20]*+[+-]?(?:(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?[dDfF]?[\x00-\x20]*+$"
    r"|0[xX]|[nN][aA][nN]|[iI][nN][fF])"
)
_PLAIN_NUMBER = "^[+-]?[0-9]+$"
FIGURES = ("filled", "missing", "mean", "stddev", "text_min", "text_max", "number_min", "number_max")
NUMBER_FIGURES = ("mean", "stddev", "number_min", "number_max")


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def _with_numbers(df: DataFrame) -> DataFrame:
    """Next to each column its value as a number (``number_<position>``), worked out once per row."""
    numbers = []
    for i, field in enumerate(df.schema):
        column = _name(field.name)
        if _is_text(field):
            value = (
                f"CASE WHEN {column} RLIKE {_literal(_PLAIN_NUMBER)} THEN try_cast({column} AS double) "
                f"WHEN {column} RLIKE {_literal(_NUMBER)} THEN try_cast({column} AS double) END"
            )
        elif isinstance(field.dataType, T.NumericType):
            value = f"CAST({column} AS double)"
        else:
            value = "CAST(NULL AS double)"
        numbers.append(f"{value} AS number_{i}")
    return df.selectExpr("*", *numbers)


def _missing(position: int, field: T.StructField) -> str:
    """NULL, or not a number written as one ('NaN' counts as missing in a text column too)."""
    return f"count_if({_name(field.name)} IS NULL OR isnan(number_{position}))"


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def missing_counts(df: DataFrame) -> DataFrame:
    """One row holding the row count and, under each column's name, its missing values."""
    counts = [f"{_missing(i, field)} AS {_name(field.name)}" for i, field in enumerate(df.schema)]
    return _with_numbers(df).selectExpr("count(1) AS row_count", *counts)


def _figures(df: DataFrame) -> tuple[list[str], str]:
    """The aggregates of all columns, and the array of their rows made of them."""
    aggregates, rows = ["count(1) AS row_count"], []
    for i, field in enumerate(df.schema):
        column, number = _name(field.name), f"number_{i}"
        text = column if _is_text(field) else "CAST(NULL AS string)"
        formulas = {
            "filled": f"count({column})",
            "missing": _missing(i, field),
            "mean": f"avg({number})",
            "stddev": f"stddev({number})",
            "text_min": f"min({text})",
            "text_max": f"max({text})",
            "number_min": f"min({number})",
            "number_max": f"max({number})",
        }
        aggregates += [f"{formulas[figure]} AS {figure}_{i}" for figure in FIGURES]
        heading = (
            f"{_literal(field.name)} AS column_name, {_literal(field.dataType.simpleString())} AS data_type, row_count"
        )
        rows.append(f"struct({heading}, {', '.join(f'{figure}_{i} AS {figure}' for figure in FIGURES)})")
    return aggregates, f"array({', '.join(rows)})"


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, counts, numeric statistics and extremes both as text and as numbers.

    Text extremes are alphabetical ('190' sorts before '36'), hence the second pair. All figures of all
    columns come from a single aggregate, so the table is scanned once and no rows are shuffled.
    """
    aggregates, rows = _figures(df)
    return _with_numbers(df).selectExpr(*aggregates).selectExpr(f"inline({rows})")


def content_key(df: DataFrame) -> list[Column]:
    """128 bits of a row's content; NULLs count by their place, which the hashes by themselves pass over."""
    columns = [F.col(_name(c)) for c in df.columns]
    empty = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    first = F.xxhash64(*columns, empty)
    return [first, F.xxhash64(empty, F.lit(7), *reversed(columns), first)]


KEY = ("_content_1", "_content_2")


def _keyed(df: DataFrame, key: Callable[[DataFrame], Sequence[Column]]) -> DataFrame:
    return df.select("*", *[c.alias(name) for c, name in zip(key(df), KEY, strict=True)])


def full_row_duplicates(df: DataFrame, key: Callable[[DataFrame], Sequence[Column]] = content_key) -> DataFrame:
    """How many rows repeat another row in every column.

    Rows are counted by content key; only those whose key repeats are then compared as they are, so different rows under one
    key are no duplicates. Copies are counted within each task first, so few of them travel in either step.
    """
    keyed = _keyed(df, key)
    repeated = keyed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select(*KEY)
    suspects = keyed.join(repeated, list(KEY), "left_semi")
    copies = suspects.groupBy(*[_name(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, and by how many; NULL counts as a key."""
    return df.groupBy(*[_name(k) for k in keys]).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def repeats(df: DataFrame, keys: Sequence[str], key: Callable[[DataFrame], Sequence[Column]] = content_key) -> DataFrame:
    """One row: rows, rows that repeat another's content, and keys held by several rows.

    Both groupings share a scan and a shuffle (grouping sets). Contents are told apart by their key of 128 bits.
    """
    keyed = _keyed(df, key).select(*KEY, *[F.col(_name(k)).alias(f"_key_{i}") for i, k in enumerate(keys)])
    names = [f"_key_{i}" for i in range(len(keys))]
    by_content = F.grouping(KEY[0]).alias("_by_key")
    groups = keyed.groupingSets([list(KEY), names], *KEY, *names).agg(F.count(F.lit(1)).alias("n"), by_content)
    content, keyed_by = F.col("_by_key") == 0, F.col("_by_key") == 1
    return groups.agg(
        F.coalesce(F.sum(F.when(content, F.col("n"))), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(content, F.col("n") - 1)), F.lit(0)).alias("duplicate_rows"),
        F.count_if(keyed_by & (F.col("n") > 1)).alias("duplicate_keys"),
    )


def profile_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The whole profile as (column_name, figure, value) rows, ready to be stored or compared over time.

    The feed is read once: the figures of its columns are observed while its rows pass on to the duplicate counts. That job
    runs here, and the report holds what it found.
    """
    aggregates, rows = _figures(df)
    seen = Observation()
    counted = _with_numbers(df).observe(seen, *[F.expr(a) for a in aggregates]).select(*[F.col(_name(c)) for c in df.columns])
    duplicates = repeats(counted, keys).first()
    spark, schema = df.sparkSession, _observed_schema(df)
    # Nothing is observed where the optimizer knows that there are no rows.
    found = seen.get if duplicates["row_count"] else {f.name: 0 for f in schema if isinstance(f.dataType, T.LongType)}
    observed = spark.createDataFrame([tuple(found.get(f.name) for f in schema)], schema)
    columns = observed.selectExpr(f"inline({rows})").selectExpr("column_name", _as_rows(("data_type", *FIGURES)))
    named = ("row_count", "duplicate_rows", "duplicate_keys")
    whole = spark.createDataFrame([tuple(duplicates[n] for n in named)], ", ".join(f"{n} bigint" for n in named))
    return columns.unionByName(whole.selectExpr("'*' AS column_name", _as_rows(named)))


def _observed_schema(df: DataFrame) -> T.StructType:
    def kind(name: str) -> T.DataType:
        figure = name.rpartition("_")[0]
        if figure in NUMBER_FIGURES:
            return T.DoubleType()
        return T.StringType() if figure.startswith("text") else T.LongType()

    names = ["row_count", *[f"{figure}_{i}" for i in range(len(df.columns)) for figure in FIGURES]]
    return T.StructType([T.StructField(name, kind(name)) for name in names])


def _as_rows(figures: Sequence[str]) -> str:
    def text(name: str) -> str:
        if name not in NUMBER_FIGURES:
            return f"CAST({name} AS string)"
        # Six decimals, unless the number is too large to have them.
        return f"coalesce(CAST(try_cast({name} AS decimal(38, 6)) AS string), CAST({name} AS string))"

    pairs = ", ".join(f"struct('{name}' AS figure, {text(name)} AS value)" for name in figures)
    return f"inline(array({pairs}))"
