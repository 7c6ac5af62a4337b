"""Toxicity by logistic regression over hashed word n-grams and skip-grams, learned by FTRL-proximal.

The features of a text are its words, its pairs of neighbouring words and its pairs with one word between, hashed into a
fixed number of coordinates; a feature is there or not, however often it occurs and however long the text is. The learner
sees one example at a time and keeps for each coordinate the sum of its gradients and of their squares: the learning rate of
a coordinate falls with its own gradients, and a coordinate whose gradients do not outweigh the L1 penalty has weight zero.
What is left is a short list of weights that goes to every task.

The fit is on a bounded sample of labelled rows, drawn by hash and for either label by itself; the intercept is put right
for the shares drawn. Texts that occur more than once are one example with their mean label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiers.llm.common import SLICE_BYTES, grams, keep, mix, raw, slices, space_table, word_hashes, words

#: Coordinates are numbers of so many bits.
BITS = 20
#: The fitted sample: rows of either label, give or take chance.
ROWS_PER_LABEL = 8000
#: Passes over the sample, and the learner's constants: rate, its damping, the penalties.
EPOCHS, ALPHA, BETA, L1, L2 = 6, 2.0, 1.0, 4.0, 0.01
#: Words whose features a task holds at once.
WINDOW = 1 << 18

_SPACE = space_table(punctuation=True)
_SALTS = [np.uint64(x) for x in (0x51, 0xA3C59AC2B7F4E1D9, 0x3C6EF372FE94F82B)]
_RANGE = 1 << 30


# Features


def _hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word. A text larger than a slice, which comes alone, is cut between words."""
    if len(data) <= 2 * SLICE_BYTES:
        begins, ends, rows = words(data, at, _SPACE)
        return word_hashes(data, begins, ends), rows
    gaps, out, begin = np.flatnonzero(_SPACE[data]), [], 0
    row = int(np.flatnonzero(np.diff(at))[0])
    while begin < len(data):
        gap = np.searchsorted(gaps, begin + SLICE_BYTES)
        end = int(gaps[gap]) + 1 if gap < len(gaps) else len(data)
        part = data[begin:end]
        begins, ends, _ = words(part, np.array([0, len(part)]), _SPACE)
        out.append(word_hashes(part, begins, ends))
        begin = end
    joined = np.concatenate(out)
    return joined, np.full(len(joined), row)


def _pairs_apart(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the one after the next, and whether both are in one row."""
    if len(hashes) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    return hashes[:-2] * np.uint64(0xD6E8FEB86659FD93) + hashes[2:], rows[:-2] == rows[2:]


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of texts (begin, end): row and coordinate of every feature, each once, in order.

    With `wanted` only coordinates marked in it.
    """
    many = np.int64(1 << BITS)
    for i, j in slices(texts):
        hashes, rows = _hashes(*raw(texts.slice(i, j - i)))
        found = [np.zeros(0, np.int64)]
        for begin in range(0, len(hashes), WINDOW):
            h, r = hashes[begin : begin + WINDOW + 2], rows[begin : begin + WINDOW + 2]
            for salt, (value, inside) in zip(_SALTS, ((h, np.ones(len(h), bool)), grams(h, r, 2), _pairs_apart(h, r)), strict=True):
                at = (mix(value ^ salt) >> np.uint64(64 - BITS)).astype(np.int64)
                if wanted is not None:
                    inside = inside & wanted[at]
                found.append(r[: len(at)][inside] * many + at[inside])
            if len(found) > 64:
                found = [np.unique(np.concatenate(found))]
        row, at = np.divmod(np.unique(np.concatenate(found)), many)
        yield i, j, row, at


# The learner


class Learner:
    """FTRL-proximal for one example at a time; the last coordinate is the intercept, which no penalty holds."""

    def __init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        held = np.where(at == 1 << BITS, 0.0, L1)
        pull = np.sign(z) * np.maximum(np.abs(z) - held, 0)
        return -pull / ((BETA + np.sqrt(n)) / ALPHA + np.where(held > 0, L2, 0.0))

    def see(self, at: np.ndarray, y: float) -> None:
        """Learn from an example: its coordinates, the intercept's among them, and its label."""
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


@dataclass
class Model:
    at: np.ndarray  # coordinates with a weight
    weight: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        table = np.zeros(1 << BITS)
        table[self.at] = self.weight
        total, wanted = np.full(len(texts), self.intercept), table != 0
        for i, j, row, at in features(texts, wanted):
            total[i:j] += np.bincount(row, table[at], minlength=j - i)
        return 1 / (1 + np.exp(-np.clip(total, -700, 700)))


def learn(examples: list[tuple[int, float, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and weights from (key, label, coordinates); equal keys are one example with their mean label."""
    labels: dict[int, list[float]] = {}
    for key, y, _ in examples:
        labels.setdefault(key, []).append(y)
    once = {key: at for key, _, at in examples}
    # In the order of the keys, which are hashes: the same whatever order the rows came in.
    order = [(np.append(once[key], 1 << BITS), float(np.mean(labels[key]))) for key in sorted(once)]
    learner = Learner()
    for _ in range(EPOCHS):
        for at, y in order:
            learner.see(at, y)
    everywhere = np.flatnonzero(learner.n)
    weight = learner.weights(everywhere)
    return everywhere[weight != 0], weight[weight != 0]


# On tables


def held_out() -> Column:
    """Rows whose label is not learned: crc32(doc_id as text) mod 5 is 0; a row without an id has no label."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _drawn(rows: DataFrame, *key: str) -> tuple[DataFrame, dict[bool, float]]:
    """About ROWS_PER_LABEL rows with `toxic` and without, drawn by a hash of the key, and the share of either drawn."""
    toxic = F.col("label") >= 0.5
    counts = {bool(r.toxic): r.n for r in rows.groupBy(toxic.alias("toxic")).agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, ROWS_PER_LABEL / n) for k, n in counts.items()}
    limit = F.when(toxic, int(share.get(True, 0) * _RANGE)).otherwise(int(share.get(False, 0) * _RANGE))
    return rows.where(F.pmod(F.xxhash64(*key), F.lit(_RANGE)) < limit), share


def fit(docs: DataFrame, labels: DataFrame, learnable: Column | None = None) -> Model | None:
    """Learn from labelled documents; None if there are none.

    A label is the mean of `toxic` over the label rows of an id, 0.5 and more being toxic; rows with NULL in either column
    are no labels. `learnable` says of a label row (by its doc_id) whether it may be used. The sample (at most about twice
    ROWS_PER_LABEL rows) is learned from in one task; nothing but the weights reaches the driver.
    """
    named = labels.select("doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    named = named.where(~held_out() if learnable is None else learnable)
    one = named.groupBy("doc_id").agg(F.avg(F.col("toxic").cast("double")).alias("label"))
    some, share = _drawn(one, "doc_id")
    if not share:
        return None
    text = F.coalesce("text", F.lit(""))
    joined = docs.select("doc_id", text.alias("text")).join(F.broadcast(some), "doc_id")
    # Ids that many rows share could make more of the sample than was drawn.
    joined, again = _drawn(joined, "doc_id", "text")
    if not again:
        return None

    def encode(batches):
        for batch in batches:
            for i, j, row, at in features(batch.column(2)):
                edge = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                coordinates = pa.ListArray.from_arrays(pa.array(edge), pa.array(at.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), coordinates], ["key", "label", "at"]
                )

    def train(batches):
        examples = []
        for batch in batches:
            edges, at = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy()
            keys, labels_ = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            examples += [(k, y, at[a:b].copy()) for k, y, a, b in zip(keys, labels_, edges[:-1], edges[1:], strict=True)]
        at, weight = learn(examples)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(weight)], ["at", "weight"])

    source = joined.select(F.xxhash64("text").alias("key"), "label", "text")
    examples = keep(source.mapInArrow(encode, "key long, label double, at array<int>"), "toxicity")
    found = examples.repartition(1).mapInArrow(train, "at long, weight double").toArrow()
    at, weight = found["at"].to_numpy(), found["weight"].to_numpy()
    own = at == 1 << BITS
    drawn = {k: share[k] * again.get(k, 1.0) for k in share}
    right = float(np.log(drawn.get(False, 1.0) / drawn.get(True, 1.0)))
    return Model(at[~own], weight[~own], float(weight[own].sum()) + right)


def score(docs: DataFrame, model: Model | None, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`columns` of every row, `score` (0 to 1, higher: likelier toxic) and `predicted` (1 from 0.5 on).

    Only the text is looked at, all of it; a NULL text is scored like an empty one, which has the intercept's score. Without a
    model every score is 0. Rows that share an id, or have none, are scored each by itself.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*columns, F.col("text").alias("__text"))

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = sent.value.scores(texts) if sent.value is not None else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                [*batch.schema.names[:-1], "score", "predicted"],
            )

    return source.mapInArrow(run, docs.select(*columns).schema.add("score", "double").add("predicted", "integer"))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, learned from the labels that are not held out."""
    found = score(docs, fit(docs, labels))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")
