"""Benchmark decontamination: rare n-gram seeds lead to candidate passages, Smith-Waterman alignment judges them.

1. Seeds are pairs of words, neighbours or with one word between, whichever of the two they are: a pair survives where no
   word of it is edited, and also where a word is put in or taken out between. An alignment that reaches half of an item's
   best score has fewer than one edit for each match, so in every other step from match to match at least a pair survives.
2. The documents are read against a bitmap of all seeds, and how many of them hold each seed is counted exactly. Of the
   seeds that occur an item uses the rarest (documents times items that have it): half, and SEEDS at least, so that it has
   some however often it was copied.
3. The documents are read again, against the seeds in use. What leaves the read are passages, stretches around seeds with
   as many words on either side as the longest item has. Texts are never shuffled.
4. Passage and item with enough seeds in common are aligned word by word. The score is the part of the item's best
   possible score that the alignment reaches; edits, insertions and deletions lower it, but do not hide a copy.

An item of one or two words is found where it is a document's whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiers.llm.common import free, grams, keep, local_alignment, mix, raw, slices, shuffled, space_table, word_hashes, words

#: Share of an item's best score from which a passage is a copy.
THRESHOLD = 0.5
#: Seeds that an item uses at least, if it has as many that occur.
SEEDS = 16
#: Seeds that passage and item have to share: two, or more where half an item is only a few words.
ENOUGH, SHORT, ENOUGH_IF_SHORT = 2, 12, 5
#: log2 of the bits of the bitmap (2 MiB).
BITMAP_BITS = 24
MATCH, MISMATCH, GAP = 2, 1, 1
#: Cells of alignment tables that are filled together.
CELLS = 1 << 19


def pairs_of(hashed: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seed and first word of every pair; in a row of one or two words a seed of the whole row instead."""
    near, same = grams(hashed, row, 2)
    wide = mix(hashed[:-2] * np.uint64(0xD6E8FEB86659FD93) + hashed[2:]) if len(hashed) > 2 else near[:0]
    apart = row[:-2] == row[2:] if len(hashed) > 2 else same[:0]
    size = np.bincount(row, minlength=int(row.max(initial=-1)) + 1)
    long = size[row] > 2
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]) & ~long) if len(row) else np.zeros(0, np.int64)
    last = first + size[row[first]] - 1
    whole = mix(hashed[first] + mix(hashed[last] ^ size[row[first]].astype(np.uint64)))
    same &= long[: len(same)]
    at = np.concatenate([np.flatnonzero(same), np.flatnonzero(apart), first])
    return np.concatenate([near[same], wide[apart], whole]), at


def item_seeds(benchmark: DataFrame) -> DataFrame:
    """A row per item text: item, item_id, n_words, item_words (hashes as bytes), seeds."""

    def run(batches):
        for batch in batches:
            data, at = raw(batch.column(1))
            begin, end, row = words(data, at, space_table(True))
            hashed = word_hashes(data, begin, end)
            cut = np.searchsorted(row, np.arange(len(at)))
            each = [hashed[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)]
            seeds = [np.unique(pairs_of(x, np.zeros(len(x), np.int64))[0]) for x in each]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in each], pa.int32()),
                    pa.array([x.tobytes() for x in each], pa.binary()),
                    pa.array([x.view(np.int64) for x in seeds], pa.list_(pa.int64())),
                ],
                ["item_id", "n_words", "item_words", "seeds"],
            )

    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, n_words int, item_words binary, seeds array<long>"
    found = benchmark.select("item_id", "text").distinct().mapInArrow(run, schema)
    return found.withColumn("item", F.xxhash64("item_id", "item_words"))


def bitmap(seeds: DataFrame) -> np.ndarray:
    """Two bits of each `seed`; at most 2^BITMAP_BITS / 64 rows reach the driver, whatever the benchmark's size."""
    both = F.explode(F.array(*[F.expr(f"shiftrightunsigned(seed, {s}) & {(1 << BITMAP_BITS) - 1}") for s in (0, 32)]))
    bits = seeds.select(both.alias("bit"))
    rows = bits.groupBy(F.expr("bit div 64").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("set"))
    out = np.zeros((1 << BITMAP_BITS) // 64, np.int64)
    found = rows.toArrow()
    out[found["at"].to_numpy()] = found["set"].to_numpy()
    return np.unpackbits(out.astype("<i8").view(np.uint8), bitorder="little").view(bool)


def hits(texts: pa.Array, bits: np.ndarray) -> tuple[np.ndarray, ...]:
    """Word hashes and row of each word, and the places and seeds of pairs whose bits are set, in order of places."""
    data, at = raw(texts)
    begin, end, row = words(data, at, space_table(True))
    hashed = word_hashes(data, begin, end)
    seed, place = pairs_of(hashed, row)
    low = np.uint64((1 << BITMAP_BITS) - 1)
    some = np.flatnonzero(bits[(seed & low).astype(np.int64)])
    some = some[bits[(seed[some] >> np.uint64(32) & low).astype(np.int64)]]
    some = some[np.argsort(place[some], kind="stable")]
    return hashed, row, place[some], seed[some]


def seed_counts(docs: DataFrame, marks) -> DataFrame:
    """seed, docs: how many rows hold each seed whose bits are set."""

    def run(batches):
        for batch in batches:
            for i, j in slices(batch.column(0)):
                _, row, hit, seed = hits(batch.column(0).slice(i, j - i), marks.value)
                order = np.lexsort((row[hit], seed))
                seed, of = seed[order], row[hit][order]
                once = np.concatenate([[True], (seed[1:] != seed[:-1]) | (of[1:] != of[:-1])]) if len(seed) else np.zeros(0, bool)
                found, n = np.unique(seed[once], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["seed", "n"])

    counts = docs.select("text").mapInArrow(run, "seed long, n long")
    return counts.groupBy("seed").agg(F.sum("n").alias("docs"))


def passages(docs: DataFrame, marks, reach: int) -> DataFrame:
    """doc_id, passage (its number), begin (first word in the document), words (hashes as bytes), seeds."""

    def run(batches):
        for batch in batches:
            for i, j in slices(batch.column(1)):
                hashed, row, hit, seed = hits(batch.column(1).slice(i, j - i), marks.value)
                if not len(hit):
                    continue
                # A new passage begins where no item could reach from the hit before.
                apart = np.flatnonzero((np.diff(hit) > reach) | (np.diff(row[hit]) > 0)) + 1
                out = []
                for part, seeds in zip(np.split(hit, apart), np.split(seed, apart), strict=True):
                    r = row[part[0]]
                    first, last = np.searchsorted(row, [r, r + 1])
                    seeds = np.unique(seeds)
                    if len(seeds) < ENOUGH and last - first > 2:
                        continue
                    a, b = max(first, part[0] - reach), min(last, part[-1] + 3 + reach)
                    text = hashed[a:b].tobytes()
                    name = mix(np.array([np.bitwise_xor.reduce(mix(hashed[a:b] + np.arange(b - a, dtype=np.uint64)))]) + np.uint64(a - first))
                    out.append((i + int(r), int(name.view(np.int64)[0]), int(a - first), text, seeds.view(np.int64)))
                if out:
                    at_row, name, begins, text, seeds = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(at_row)),
                            pa.array(name, pa.int64()),
                            pa.array(begins, pa.int32()),
                            pa.array(text, pa.binary()),
                            pa.array(seeds, pa.list_(pa.int64())),
                        ],
                        ["doc_id", "passage", "begin", "words", "seeds"],
                    )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, passage long, begin int, words binary, seeds array<long>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def align(pairs: DataFrame) -> DataFrame:
    """Score of each pair of `item_words` and `words`: doc_id, item_id, score, word (last word of the copy)."""

    def run(batches):
        for batch in batches:
            item = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column("item_words")]
            text = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column("words")]
            n = np.array([len(x) for x in text])
            order = np.argsort(n, kind="stable")
            score, word = np.zeros(len(n)), np.zeros(len(n), np.int64)
            while len(order):
                k = 1
                while k < len(order) and (k + 1) * n[order[k]] <= CELLS:
                    k += 1
                now, order = order[:k], order[k:]
                best, end = local_alignment([item[i] for i in now], [text[i] for i in now], MATCH, MISMATCH, GAP)
                score[now] = best / np.maximum([MATCH * len(item[i]) for i in now], 1)
                word[now] = end
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("item_id"),
                    batch.column("shared"),
                    pa.array(score),
                    pc.add(batch.column("begin").cast(pa.int64()), pa.array(word)),
                ],
                ["doc_id", "item_id", "shared", "score", "last_word"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}
    schema = f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, shared long, score double, last_word long"
    return pairs.select("doc_id", "item_id", "shared", "begin", "words", "item_words").mapInArrow(run, schema)


def used_seeds(items: DataFrame, counts: DataFrame) -> DataFrame:
    """item, seed: the rarer half of the seeds of each item that occur, SEEDS at least."""
    seeds = items.select("item", F.explode("seeds").alias("seed")).distinct()
    in_items = seeds.groupBy("seed").agg(F.count("*").alias("items"))
    spread = seeds.join(in_items, "seed").join(counts, "seed")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("docs") * F.col("items"), "seed"))
    all_ = F.count("*").over(Window.partitionBy("item"))
    ranked = spread.select("item", "seed", place.alias("place"), all_.alias("all"))
    return ranked.where(F.col("place") <= F.greatest(F.lit(SEEDS), F.ceil(F.col("all") / 2))).select("item", "seed")


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row per document and benchmark item found in it: doc_id, item_id, score (0 to 1), seeds, last_word.

    NULL and empty texts match nothing. Rows that share a doc_id (NULL included) count as one document; the best passage
    gives the score, and among equal ones the earliest the last word.
    """
    items = keep(item_seeds(benchmark), "leak-items")
    reach = items.agg(F.max("n_words")).first()[0] or 0
    context = docs.sparkSession.sparkContext
    every = context.broadcast(bitmap(items.select(F.explode("seeds").alias("seed"))))
    used = keep(used_seeds(items, seed_counts(docs, every)), "leak-seeds")
    marks = context.broadcast(bitmap(used.select("seed")))
    found = keep(passages(docs, marks, reach), "leak-passages")
    hit = found.select("doc_id", "passage", F.explode("seeds").alias("seed"))
    met = hit.join(shuffled(used), "seed").groupBy("passage", "item").agg(F.countDistinct("seed").alias("shared"))
    wanted = F.when(F.col("n_words") < SHORT, ENOUGH_IF_SHORT).otherwise(ENOUGH)
    about = items.withColumn("enough", F.least(F.size("seeds"), wanted)).select("item", "item_id", "item_words", "enough")
    pairs = met.join(about.dropDuplicates(["item"]), "item").where("shared >= enough")
    texts = found.groupBy("doc_id", "passage").agg(F.first("begin").alias("begin"), F.first("words").alias("words"))
    scored = align(pairs.join(texts, "passage")).where(F.col("score") >= threshold)
    best = F.max(F.struct("score", (-F.col("last_word")).alias("early"), "shared")).alias("best")
    return scored.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("best.score").alias("score"), F.col("best.shared").alias("seeds"), (-F.col("best.early")).alias("last_word")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item; rows that share an id, or have none, are judged each by its own text."""
    key = F.concat_ws(":", F.hex(F.xxhash64("text")), F.col("doc_id").cast("string"))
    bad = leaks(docs.select(key.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias(free(docs, "bad"))).distinct()
    return docs.join(bad.hint("shuffle_hash"), key == F.col(bad.columns[0]), "left_anti")
