"""SimHash near-duplicates found by bit counts of fingerprint segments.

A fingerprint is cut into 16 segments of 4 bits; its bit counts are a point with 16 coordinates from 0 to 4. Two
fingerprints that differ in at most two bits have points at a Manhattan distance of at most two (a lower bound), so some
point is within one step of both. Each fingerprint is therefore entered at its point and at the up to 32 points next to
it, and fingerprints that meet at a point are compared bit by bit. Where more than `CROWD` meet, they are entered once
more by themselves and with each single bit flipped; those that share such a key differ in at most two bits, and at most
65 different ones can. So no group is ever compared pair by pair beyond a fixed size, and no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tiers.llm.common import components, free, keep, own, shuffled

#: Fingerprints at one point that are compared pair by pair; it only chooses between two exact ways.
CROWD = 64
#: Shingles whose bits are counted together, a bound on memory.
BLOCK = 1 << 16


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """Bits set in over half the hashes of a text's word shingles, as a signed 64-bit number; 0 without words."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    if len(found) <= size:
        hashed = [xxhash.xxh64_intdigest(b" ".join(found), seed)]
    else:
        joined, length = b" ".join(found), [len(w) for w in found]
        begins = np.cumsum([0] + [n + 1 for n in length[:-1]])
        ends = begins[size - 1 :] + length[size - 1 :]
        digest = xxhash.xxh64_intdigest
        hashed = [digest(joined[i:j], seed) for i, j in zip(begins.tolist(), ends.tolist(), strict=False)]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashed), BLOCK):
        part = np.array(hashed[i : i + BLOCK], ">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashed))
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, size: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and `fp` of each row."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(t.as_py(), size, seed) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def grid_keys(fp: str) -> Column:
    """The fingerprint's point, bit counts packed into the digits of one number, and all points one step away."""
    digits = " | ".join(f"shiftleft(cast(bit_count(shiftrightunsigned({fp}, {4 * i}) & 15) as bigint), {4 * i})" for i in range(16))
    step = "if(shiftrightunsigned(p, 4 * i) & 15 {0}, p {1} shiftleft(1L, 4 * i), null)"
    steps = f"flatten(transform(sequence(0, 15), i -> array({step.format('< 4', '+')}, {step.format('> 0', '-')})))"
    return F.expr(f"transform(array({digits}), p -> concat(array(p), array_compact({steps})))[0]")


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs `a`, `b` of distinct fingerprints (column `fp`) that connect all that differ in at most two bits."""
    entered = fps.select("fp", F.explode(grid_keys("fp")).alias("point"))
    sizes = entered.groupBy("point").agg(F.count("*").alias("n")).where("n > 1")
    met = entered.join(shuffled(sizes), "point")
    few = met.where(F.col("n") <= crowd).groupBy("point").agg(F.array_sort(F.collect_list("fp")).alias("all"))
    pair = F.expr(
        "flatten(transform(all, x -> transform(filter(all, y -> x < y and bit_count(x ^ y) <= 2),"
        " y -> named_struct('a', x, 'b', y))))"
    )
    near = few.select(F.explode(pair).alias("p")).select("p.a", "p.b")
    flips = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    ball = met.where(F.col("n") > crowd).select("fp").distinct().select("fp", F.explode(flips).alias("key"))
    shared = ball.groupBy("key").agg(F.array_sort(F.collect_list("fp")).alias("all")).where(F.size("all") > 1)
    hub = shared.select(F.col("all")[0].alias("a"), F.explode(F.slice("all", 2, 65)).alias("b"))
    return near.union(hub).distinct()


def grouped(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, fp, root (a fingerprint that names the group) and component_id of each row."""
    fps = keep(fingerprints(docs), "simhash")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(classes.select("fp"), crowd), "simhash-links")
    named = classes.join(shuffled(roots), classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    table = named.join(shuffled(names), "root").select("fp", "root", "component_id")
    return fps.join(shuffled(table), "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id (smallest doc_id linked, directly or through others).

    NULL and empty texts have fingerprint zero and link to one another. Rows without a doc_id take part, but give a
    group no name: a group of such rows only has component_id NULL. Repeated rows come out as often as they came in.
    """
    return grouped(docs, crowd).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def with_fingerprint(docs: DataFrame) -> DataFrame:
    """The rows as one column, `row`, and their fingerprint, `fp`."""

    def run(batches):
        for batch in batches:
            found = pa.array([fingerprint(t.as_py()) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["row", "fp"])

    rows = docs.select(F.struct(*own(docs)).alias("row"), "text")
    return rows.mapInArrow(run, StructType([rows.schema["row"], StructField("fp", LongType())]))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the smallest doc_id stays, once.

    Of a group without any doc_id one row stays. Texts of several groups under one id, or without one, stay for each group.
    """
    found = keep(grouped(docs), "simhash-kept")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("least")
    first = keep(found.groupBy("root").agg(least).select("least.doc_id", "least.fp"), "simhash-first")
    again = found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias("again"))
    again = keep(first.join(shuffled(again), F.col("doc_id").eqNullSafe(F.col("again")), "left_semi"), "simhash-rows")
    # Texts move once; only rows that share an id, or have none, are told apart by more than the id.
    once = first.where("doc_id is not null").select("doc_id").join(shuffled(again.select("doc_id")), "doc_id", "left_anti")
    single = docs.join(once.hint("shuffle_hash"), "doc_id", "left_semi").select(own(docs))
    if again.isEmpty():
        return single
    key = free(docs, "kept_id")
    more = again.select(F.col("doc_id").alias(key), F.col("fp").alias("of"))
    several = with_fingerprint(docs.join(shuffled(more), F.col("doc_id").eqNullSafe(F.col(key)), "left_semi")).withColumn("id", F.col("row.doc_id"))
    several = several.join(shuffled(more), F.col("id").eqNullSafe(F.col(key)) & (F.col("fp") == F.col("of")), "left_semi")
    return single.union(several.dropDuplicates(["id", "fp"]).select("row.*"))
