"""What several operators share: tables, byte-level words, seeds, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.sources.workdir import new_folder

#: Bytes of text that a task looks at together; a longer text is taken alone.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's switch for removing the shuffle files of a query as soon as it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, label: str, drop_shuffles: bool = False) -> DataFrame:
    """Write a step to the shared folder and read it back: lineage ends there, and no executor's loss undoes it.

    With ``drop_shuffles`` the shuffle files of the write are removed when it ends, since nothing reads them again:
    where a step shuffles much, they would otherwise lie on disk beside everything after it.
    """
    path = new_folder(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    if drop_shuffles:
        conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if drop_shuffles:
            conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """The frame, to be joined by a shuffle: nothing of it, or of the other side, goes through the driver as a broadcast.

    Spark sizes a table by its files, or by what it was made of: too low after an explode, or where values repeat.
    """
    return df.hint("merge")


def own(df: DataFrame) -> list[Column]:
    """The frame's columns, whatever they are called."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def free(df: DataFrame, name: str) -> str:
    """A name that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


# Words


def space_table(punctuation: bool = False) -> np.ndarray:
    """Which bytes separate words: white space, and ASCII punctuation if wanted."""
    out = np.zeros(256, bool)
    out[[9, 10, 11, 12, 13, 32]] = True
    if punctuation:
        out[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
    return out


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about `most` bytes of text."""
    length = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, n in enumerate(length):
        if total and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += int(n)
    if begin < len(texts):
        yield begin, len(texts)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the n + 1 offsets of its rows; NULL is empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    return body, at - at[0]


def words(data: np.ndarray, at: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of every word; no word crosses rows."""
    solid = ~space[data]
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    edge = at[:-1][at[:-1] < len(data)]
    begin[edge] = solid[edge]
    edge = edge[edge > 0]
    end[edge - 1] = solid[edge - 1]
    begins = np.flatnonzero(begin)
    return begins, np.flatnonzero(end) + 1, np.searchsorted(at, begins, "right") - 1


BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse modulo 2^64 to the powers 0 to n."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, ASCII letters in lower case."""
    upper = (data >= 65) & (data <= 90)
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + upper * np.uint8(32)).astype(np.uint64) * up[: len(data)] + np.uint64(0), out=total[1:])
    return mix((total[ends] - total[begins]) * down[begins] + (ends - begins).astype(np.uint64) * np.uint64(BASE))


def grams(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, and whether all k are in one row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + n]
    return mix(out), rows[:n] == rows[k - 1 :]


# Alignment


def local_alignment(a: list[np.ndarray], b: list[np.ndarray], match: int, mismatch: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Best Smith-Waterman score of each pair of word sequences, and the end of the alignment in the second.

    All pairs advance together, a row of their tables at a time; within a row the gaps are a running maximum.
    """
    n, wide, high = len(a), max(map(len, b), default=0), max(map(len, a), default=0)
    best, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n or not wide or not high:
        return best, end
    second, inside = np.zeros((n, wide), np.uint64), np.zeros((n, wide), bool)
    for i, x in enumerate(b):
        second[i, : len(x)], inside[i, : len(x)] = x, True
    slope = gap * np.arange(wide + 1, dtype=np.int32)
    row = np.zeros((n, wide + 1), np.int32)
    for k in range(high):
        live = np.flatnonzero([len(x) > k for x in a])
        symbol = np.array([a[i][k] for i in live], np.uint64)[:, None]
        same = (second[live] == symbol) & inside[live]
        old = row[live]
        new = np.zeros_like(old)
        new[:, 1:] = np.maximum(old[:, :-1] + np.where(same, match, -mismatch), old[:, 1:] - gap)
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new + slope, axis=1) - slope
        row[live] = new
        top = new.argmax(axis=1)
        value = new[np.arange(len(live)), top]
        better = value > best[live]
        best[live[better]], end[live[better]] = value[better], top[better]
    return best, end


# Connected components


def components(edges: DataFrame, label: str) -> DataFrame:
    """The smallest node reachable from each node that has an edge: columns `node`, `root`.

    Edges are pairs of longs `a`, `b`. Large and small stars alternate until every node hangs from its root; a star
    costs rows in proportion to the edges, and the rounds grow with the logarithm of the longest path.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    def star(df: DataFrame, large: bool) -> DataFrame:
        """a > b throughout; each node hands its neighbours (large: the greater, small: the less) to the least it knows."""
        near = df.union(df.select(F.col("b"), F.col("a"))) if large else df
        least = near.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        met = near.join(shuffled(least), "a")
        if large:
            return met.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        moved = met.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        return moved.union(least.select("a", F.col("least").alias("b"))).distinct()

    now = keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), label)
    seen = mark(now)
    while seen[0]:
        now = keep(star(star(now, True), False), label)
        before, seen = seen, mark(now)
        if seen == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
