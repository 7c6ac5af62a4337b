"""Outer equi-joins which stay spread out when one key holds very many rows.

Adaptive execution splits an oversized left side of a left join by itself, but neither an oversized right
side nor any side of a full join. ``spread_join`` covers those two:

* rows with a NULL key match nothing, so in a full join they are dealt out over all tasks by an extra join
  column instead of meeting in one;
* keys that may be hot are looked for first, in base tables and with columns pruned to the key: a sketch of
  frequent items, one scan in which no key is moved. Only the candidates it names are then counted exactly;
  without any it is the plain join. A key with more rows than a task should get is laid out as a grid: each
  side is dealt over its own number of shards and repeated over those of the other, so every pair of rows
  meets in exactly one cell. Rows are repeated only for keys that the other side is seen to hold, within the
  same query; such a row matches in some cell, so where it met nothing it is only a repetition, and is
  dropped. The counts decide the layout, never which rows result. All other keys have one cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import mul, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.session import shuffles_dropped

ROWS_PER_SHARD = 2_000_000  # rows of one key that a task gets; a key with more is hot
# Keys a sketch keeps track of: it is sure to name each that holds more than about a 9,000th of all rows. Keys
# below that are left to one task even where they exceed ROWS_PER_SHARD, in tables of more than 18 billion rows.
TRACKED_KEYS = 1 << 16
LISTED_KEYS = 10_000  # candidates a sketch may name; with more the keys are counted without one
SKETCHES = 64  # sketches that tasks merge theirs into, before those become one


def _dealt(df: DataFrame) -> Column:
    """Number to deal a row by: the same on a task retry, yet different for copies from different tasks."""
    return F.xxhash64(F.spark_partition_id(), *df.columns)


def _unknown(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _null_cells(df: DataFrame) -> int:
    """Cells for rows that match nothing: some to each task, so that tasks get about as many."""
    return 32 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_rows(probes: Sequence[DataFrame], keys: Sequence[str], name: str) -> DataFrame:
    """Rows of each key in an outer join of the probes: the product of its counts."""
    counts = [
        df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias(f"_rows_{i}"))
        for i, df in enumerate(probes)
    ]
    joined = reduce(lambda a, b: a.join(b, list(keys), "full"), counts)
    product = reduce(mul, [F.coalesce(f"_rows_{i}", F.lit(1.0)) for i in range(len(counts))])
    return joined.select(*keys, product.alias(name))


def _place(keys: Sequence[str]) -> Column:
    return F.when(~_unknown(keys), F.xxhash64(*keys))


class Probe:
    """A table in which frequent keys are looked for: one scan, whatever the number of keys it is asked about."""

    def __init__(self, df: DataFrame, *key_sets: Sequence[str]):
        self.df = df
        self.key_sets = [tuple(keys) for keys in key_sets]
        self._found: dict[tuple[str, ...], list] | None = None

    def frequent(self, keys: Sequence[str]) -> list[tuple[int, int]]:
        """Hash and rough count of the most frequent keys, the most frequent first."""
        if tuple(keys) not in self.key_sets:
            return Probe(self.df, keys).frequent(keys)
        if self._found is None:
            self._found = dict(zip(self.key_sets, self._look(), strict=True))
        return self._found[tuple(keys)]

    def _look(self) -> list[list[tuple[int, int]]]:
        names = [f"sketch_{i}" for i in range(len(self.key_sets))]
        places = self.df.select(*[_place(keys).alias(n) for keys, n in zip(self.key_sets, names, strict=True)])
        # Sketches of nothing cannot be combined, so there is one row more, without a key.
        places = places.union(self.df.sparkSession.range(1).select(*[F.lit(None).cast("bigint") for _ in names]))
        group = F.pmod(F.spark_partition_id(), F.lit(SKETCHES)).alias("group")
        some = places.groupBy(group).agg(*[F.expr(f"approx_top_k_accumulate({n}, {TRACKED_KEYS})").alias(n) for n in names])
        one = some.coalesce(1).agg(*[F.expr(f"approx_top_k_combine({n}, {TRACKED_KEYS})").alias(n) for n in names])
        # A probe may be cleaned rows: what that shuffles is as large as in the join, and nothing reads it again.
        with shuffles_dropped(self.df.sparkSession):
            row = one.select(*[F.expr(f"approx_top_k_estimate({n}, {LISTED_KEYS})").alias(n) for n in names]).first()
        return [[(item, n) for item, n in found or () if item is not None] for found in row]


def candidates(probes: Sequence[Probe], keys: Sequence[str], rows_per_shard: int) -> set[int] | None:
    """Hashes of the keys whose product of counts may exceed a shard; None if there are too many to list.

    Where a product exceeds it, one of the factors exceeds its root.
    """
    least, out = rows_per_shard ** (1 / max(1, len(probes))), set()
    for probe in probes:
        found = [(item, n) for item, n in probe.frequent(keys) if n > least]
        if len(found) >= LISTED_KEYS:
            return None
        out.update(item for item, _ in found)
    return out


def _probes(frames: Sequence[DataFrame | Probe], keys: Sequence[str]) -> list[Probe]:
    return [f if isinstance(f, Probe) else Probe(f, keys) for f in frames]


def hot_keys(
    left: Sequence[DataFrame | Probe],
    right: Sequence[DataFrame | Probe],
    keys: Sequence[str],
    how: str,
    rows_per_shard: int,
) -> dict[tuple, tuple[int, int]]:
    """Shards of either side for each hot key; their number is bounded by all rows over the rows of a shard."""
    # The left side of a left join is split anyway.
    sides = {"_left": _probes(left, keys) if how == "full" else [], "_right": _probes(right, keys)}
    sides = {side: probes for side, probes in sides.items() if probes}
    named = [candidates(probes, keys, rows_per_shard) for probes in sides.values()]
    if not any(c is None or c for c in named):
        return {}

    def narrowed(df: DataFrame) -> DataFrame:
        if None in named:
            return df
        items = df.sparkSession.createDataFrame([(i,) for i in set().union(*named)], "_place bigint")
        return df.withColumn("_place", _place(keys)).join(F.broadcast(items), "_place", "left_semi").drop("_place")

    counts = [key_rows([narrowed(p.df) for p in probes], keys, side) for side, probes in sides.items()]
    rows = reduce(lambda a, b: a.join(b, list(keys), "full"), counts).fillna(0.0, list(sides))
    absent = 0.0 if how == "full" else 1.0
    rows = rows.withColumns({side: F.lit(absent) for side in ("_left", "_right") if side not in sides})
    shards = [F.ceil(F.col(side) / rows_per_shard).cast("int") for side in ("_left", "_right")]
    with shuffles_dropped(rows.sparkSession):
        hot = rows.where(F.greatest("_left", "_right") > rows_per_shard).select(*keys, *shards).collect()
    return {tuple(row)[:-2]: tuple(row)[-2:] for row in hot}


def plain_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """The join as it is, with NULL keys dealt out where they would take part in a shuffle for nothing."""
    if how != "full":
        return left.join(right, list(keys), how)

    def spread(df: DataFrame) -> DataFrame:
        cell = F.when(_unknown(keys), F.pmod(_dealt(df), F.lit(_null_cells(df)))).otherwise(F.lit(0))
        return df.withColumn("_cell", cell)

    return spread(left).join(spread(right), [*keys, "_cell"], "full").drop("_cell")


def grid_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    hot: dict[tuple, tuple[int, int]],
    left_probes: Sequence[DataFrame],
    split_left: bool = False,
) -> DataFrame:
    """Join with the hot keys laid out as grids; ``hot`` holds the numbers of shards of either side.

    No shards on one side mean that the key does not occur there: its rows are dealt out but not repeated.
    """
    fields = [T.StructField(k, left.schema[k].dataType) for k in keys]
    fields += [T.StructField(f"_shards_{side}", T.IntegerType()) for side in ("left", "right")]
    grid = F.broadcast(left.sparkSession.createDataFrame([(*k, *n) for k, n in hot.items()], T.StructType(fields)))

    def held(frames: Sequence[DataFrame]) -> DataFrame:
        """The hot keys that really occur in the frames: no more rows than the grid has."""
        found = reduce(DataFrame.union, [df.select(*keys).join(grid.select(*keys), list(keys), "left_semi") for df in frames])
        return F.broadcast(found.distinct().withColumn("_held", F.lit(True)))

    def lay_out(df: DataFrame, own: str, other: str, across: DataFrame | None) -> DataFrame:
        known = df.withColumn("_dealt", _dealt(df)).join(grid, list(keys), "left")
        known = known.withColumn("_held", F.lit(None).cast("boolean")) if across is None else known.join(across, list(keys), "left")
        shards, repeats = F.col(f"_shards_{own}"), F.col(f"_shards_{other}")
        dealt = F.when(shards > 0, F.pmod("_dealt", shards)).otherwise(F.lit(0))
        if how == "full":
            dealt = F.when(_unknown(keys), F.pmod("_dealt", F.lit(_null_cells(df)))).otherwise(dealt)
        cells = F.when(F.col("_held"), F.greatest(repeats, F.lit(1))).otherwise(F.lit(1))
        return known.select(
            *df.columns,
            F.coalesce("_held", F.lit(False)).alias(f"_hot_{own}"),
            dealt.cast("int").alias(f"_cell_{own}"),
            F.explode(F.sequence(F.lit(0), cells - 1)).alias(f"_cell_{other}"),
        )

    joined = lay_out(left, "left", "right", held([right])).join(
        # With one shard on the left the right side is never repeated.
        lay_out(right, "right", "left", held(left_probes) if how == "full" or split_left else None),
        [*keys, "_cell_left", "_cell_right"],
        how,
    )
    on_left, on_right = F.col("_hot_left"), F.col("_hot_right")
    repetition = (on_left & on_right.isNull()) | (on_right & on_left.isNull())
    helpers = ["_cell_left", "_cell_right", "_hot_left", "_hot_right"]
    return joined.filter(~F.coalesce(repetition, F.lit(False))).drop(*helpers)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    left_probes: Sequence[DataFrame | Probe] | None = None,
    right_probes: Sequence[DataFrame | Probe] | None = None,
    rows_per_shard: int = ROWS_PER_SHARD,
    split_left: bool = False,
) -> DataFrame:
    """``left`` or ``full`` equi-join on named columns that no hot key can pile up in one task.

    Frequent keys are looked for in the probes, by default the sides themselves. Pass the base tables where a
    side is itself a join, so that looking does not run that join; those of the left side of a full join have to
    hold exactly its keys. An empty list says that no key of the side occurs often, and nothing is looked for. ``split_left`` also lays out hot keys of the left side of a left join, which
    adaptive execution cannot split where the right side is read in buckets.
    """
    if how not in ("left", "full"):
        raise ValueError(f"unsupported join type: {how}")
    if any(left.schema[k].dataType != right.schema[k].dataType for k in keys):
        raise ValueError("join columns must have the same type on both sides")
    left_probes = [left] if left_probes is None else left_probes
    right_probes = [right] if right_probes is None else right_probes
    hot = hot_keys(left_probes, right_probes, keys, "full" if split_left else how, rows_per_shard)
    if hot:
        bases = [p.df if isinstance(p, Probe) else p for p in left_probes] or [left]
        return grid_join(left, right, keys, how, hot, bases, split_left)
    return plain_join(left, right, keys, how)
