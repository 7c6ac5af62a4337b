"""Language identification by prediction by partial matching over bytes.

For each language a context tree holds how often each byte followed each context of up to three bytes. A byte seen n
times after a context whose followers were counted t times, d of them different, costs -log2(n / (t + d)) bits; the rest,
d / (t + d), is the escape to the context shorter by a byte, shared out over the bytes not seen in the longer one, down
to 1/256 for every byte. These costs add up to a proper code, so a text's total under a language is the exact length that
an arithmetic coder with these frozen counts would need. The language with the shortest code is predicted.

The trees of some languages at a time are unfolded once into one table: a row for each known context, a column for each
byte, in each field the cost under each language. A text is then scored by table look-ups without state. More languages
make more tables; none gets fewer contexts for it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiers.llm.common import keep, own, raw, slices

#: The fitted sample: documents a language, give or take chance, and characters of each.
DOCS_PER_LANG, CHARS_PER_DOC = 1000, 10_000
#: Languages that share a table of costs, and its bytes at most; all languages of the sample are learned.
LANGS_TOGETHER, TABLE_BYTES = 8, 64 << 20
#: What a text is taken to follow.
BEFORE = 32
#: Bits a byte of an uncoded text. A text is in no learned language if it costs that much, or SLACK times what the
#: costliest text of its language's sample does.
RAW_BITS, SLACK = 8.0, 2.0


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # byte to column
    node: np.ndarray  # three columns of context to row of the table
    cost: np.ndarray  # rows x columns x languages, bits
    limits: dict[str, float] = field(default_factory=dict)  # the most bits a byte that a text of each language has

    def bits(self, texts: pa.Array) -> np.ndarray:
        """Code length of each text under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        wide = self.cost.shape[1]
        flat = self.cost.reshape(-1, len(self.langs))
        for i, j in slices(texts):
            data, at = raw(texts.slice(i, j - i))
            total = np.zeros((j - i, len(self.langs)))
            # A long text goes in pieces: what a byte costs depends on the three before it alone.
            for begin in range(0, len(data), 1 << 20):
                end = min(len(data), begin + (1 << 20))
                far = max(0, begin - 3)
                symbol = self.code[data[far:end]].astype(np.int64)
                near = [np.concatenate([np.full(k, self.code[BEFORE]), symbol[: len(symbol) - k]]) for k in (1, 2, 3)]
                starts = at[:-1][(at[:-1] >= far) & (at[:-1] < end)] - far
                for k, past in enumerate(near, 1):
                    for shift in range(k):
                        edge = starts + shift
                        past[edge[edge < len(past)]] = self.code[BEFORE]
                row = self.node[(near[2] * wide + near[1]) * wide + near[0]]
                paid = flat[row * wide + symbol][begin - far :]
                run = np.zeros((len(paid) + 1, len(self.langs)))
                np.cumsum(paid, axis=0, out=run[1:])
                clipped = np.clip(at, begin, end) - begin
                total += run[clipped[1:]] - run[clipped[:-1]]
            out[i:j] = total
        return out


@dataclass
class Models:
    """Several tables, for more languages than one holds."""

    tables: list[Model]
    limits: dict[str, float] = field(default_factory=dict)

    @property
    def langs(self) -> list[str]:
        return [lang for t in self.tables for lang in t.langs]

    def bits(self, texts: pa.Array) -> np.ndarray:
        return np.concatenate([t.bits(texts) for t in self.tables], axis=1)


def learnable(docs: DataFrame, bucket: Column) -> DataFrame:
    """`lang`, `text` of the sample: rows with both, and `bucket` true; of each language about DOCS_PER_LANG, drawn by hash."""
    rows = docs.where(F.col("lang").isNotNull() & bucket)
    # As many rows as there are languages.
    most = rows.groupBy("lang").agg(F.count("*").alias("n"))
    range_ = 1 << 30
    share = F.ceil(F.lit(float(DOCS_PER_LANG * range_)) / F.col("n"))
    drawn = rows.join(F.broadcast(most.select("lang", share.alias("share"))), "lang")
    drawn = drawn.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(range_)) < F.col("share")).where(F.col("text").isNotNull())
    return drawn.select("lang", F.expr(f"left(text, {CHARS_PER_DOC})").alias("text"))


def count_contexts(sample: DataFrame) -> DataFrame:
    """lang, four bytes as a number, and how often they follow one another (`n`); `docs` counts for the language."""

    def grams(lang, texts):
        data, at = raw(texts)
        begins = at[:-1] + 3 * np.arange(len(texts))
        padded = np.full(len(data) + 3 * len(texts), BEFORE, np.int64)
        inside = np.ones(len(padded), bool)
        for k in range(3):
            inside[begins + k] = False
        padded[inside] = data
        key = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:] if len(padded) > 3 else padded[:0]
        found, n = np.unique(key[inside[3:]], return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(n)], ["lang", "gram", "n"]
        )

    def run(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in sorted(set(langs)):
                every = batch.column(1).filter(pa.array(langs == lang))
                # Whole texts: a slice of about SLICE_BYTES at a time keeps the arrays below bounded.
                for i, j in slices(every):
                    yield from grams(lang, every.slice(i, j - i))

    return sample.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learned(docs: DataFrame, bucket: Column) -> DataFrame:
    """`lang`, `text` of every row to learn from: both not null, and `bucket` true; the whole text."""
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & bucket).select("lang", "text")


def fit(docs: DataFrame, bucket: Column | None = None) -> Model | Models | None:
    """Learn from every row in `bucket` with a lang and a text; None if there is nothing to learn from.

    What reaches the driver is a count for each distinct four bytes of each language, summed on Spark. The tables take
    TABLE_BYTES for each LANGS_TOGETHER languages.
    """
    # Read again for the limits, so that the costliest text of each language is taken over all its texts.
    sample = learned(docs, F.lit(True) if bucket is None else bucket)
    counts = keep(count_contexts(sample), "langid")
    rows = counts.toArrow()
    langs = sorted(set(rows["lang"].to_pylist()))
    if not langs:
        return None
    lang = np.searchsorted(np.array(langs), np.array(rows["lang"].to_pylist()))
    gram, n, tables = rows["gram"].to_numpy(), rows["n"].to_numpy(), []
    for first in range(0, len(langs), LANGS_TOGETHER):
        mine = (lang >= first) & (lang < first + LANGS_TOGETHER)
        tables.append(build(langs[first : first + LANGS_TOGETHER], lang[mine] - first, gram[mine], n[mine]))
    models = Models(tables) if len(tables) > 1 else tables[0]
    costs = predict(sample, models, ("lang",)).where("lang = lang_pred").groupBy("lang").agg(F.max("bits_per_byte").alias("most"))
    models.limits = {r.lang: r.most for r in costs.collect()}
    return models


def build(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """Unfold the context trees into the table of costs."""
    octet = gram & 255
    seen = np.bincount(octet, n, 256)
    seen[BEFORE] += 1
    own = np.flatnonzero(seen > 0)[:255]  # UTF-8 does not use all bytes
    wide, many = len(own) + 1, len(langs)
    code = np.full(256, wide - 1, np.int64)
    code[own] = np.arange(len(own))
    share = np.ones(wide)
    share[-1] = 256 - len(own)  # bytes in the last column
    last = code[octet]
    past = [code[gram >> s & 255] for s in (8, 16, 24)]
    known = last < wide - 1

    def spread(context: np.ndarray, parent: np.ndarray, size: int) -> np.ndarray:
        """Probability of a byte of each column after each context, given those after the contexts shorter by one."""
        out = parent.astype(np.float32)
        for k in range(many):
            mine = known & (lang == k) & (context >= 0)
            counts = np.zeros((size, wide), np.float32)
            np.add.at(counts, (context[mine], last[mine]), n[mine])
            total, kinds = counts.sum(1), (counts > 0).sum(1)
            rest = (out[:, :, k] * share * (counts == 0)).sum(1)
            scale = np.where(total > 0, kinds / np.maximum(total + kinds, 1) / np.maximum(rest, 1e-12), 1)
            coded = counts / np.maximum(total + kinds, 1)[:, None]
            out[:, :, k] = np.where(counts > 0, coded, out[:, :, k] * scale[:, None])
        return out

    flat = np.full((1, wide, many), 1 / 256, np.float32)
    zero = spread(np.zeros(len(gram), np.int64), flat, 1)
    one = spread(past[0], np.repeat(zero, wide, axis=0), wide)
    # Longer contexts get a row if seen twice, the most frequent first, as far as the table's size allows.
    room = max(0, TABLE_BYTES // (4 * wide * many) - wide)
    two_key, two = np.unique(past[1] * wide + past[0], return_inverse=True)
    weight = np.bincount(two, n)
    chosen = np.flatnonzero(weight >= 2)
    chosen = np.sort(chosen[np.argsort(-weight[chosen], kind="stable")[: room // 2]])
    place = np.full(len(two_key), -1)
    place[chosen] = np.arange(len(chosen))
    second = spread(place[two], one[two_key[chosen] % wide], len(chosen))
    node = np.tile(np.arange(wide, dtype=np.int32), wide * wide).reshape(wide * wide, wide)
    node = node.reshape(-1)
    pairs = np.full(wide * wide, -1, np.int64)
    pairs[two_key[chosen]] = np.arange(len(chosen))
    tail = np.arange(wide**3) % (wide * wide)
    node = np.where(pairs[tail] >= 0, wide + pairs[tail], node).astype(np.int32)
    three_key, three = np.unique((past[2] * wide + past[1]) * wide + past[0], return_inverse=True)
    weight = np.bincount(three, n)
    chosen3 = np.flatnonzero((weight >= 2) & (pairs[three_key % (wide * wide)] >= 0))
    chosen3 = np.sort(chosen3[np.argsort(-weight[chosen3], kind="stable")[: max(0, room - len(chosen))]])
    place = np.full(len(three_key), -1)
    place[chosen3] = np.arange(len(chosen3))
    third = spread(place[three], second[pairs[three_key[chosen3] % (wide * wide)]], len(chosen3))
    node[three_key[chosen3]] = wide + len(chosen) + np.arange(len(chosen3))
    cost = -np.log2(np.maximum(np.concatenate([one, second, third]), 1e-30))
    return Model(langs, code, node, np.ascontiguousarray(cost, np.float32))


def has_letter(texts: pa.Array) -> np.ndarray:
    out = np.zeros(len(texts), bool)
    for i, j in slices(texts):
        data, at = raw(texts.slice(i, j - i))
        low = data | 32
        run = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122))])
        out[i:j] = run[at[1:]] > run[at[:-1]]
        for k in np.flatnonzero(~out[i:j]):
            text = texts[i + int(k)].as_py()
            out[i + k] = bool(text) and any(c.isalpha() for c in text)
    return out


def predict(docs: DataFrame, model: Model | Models | None, columns: tuple[str, ...]) -> DataFrame:
    """`columns` of every row, and lang_pred, score (0 to 1), bits_per_byte.

    The score is the share of the predicted language if all are as likely beforehand; ties go to the first by name. A NULL
    text, one without a letter, or one judged without a model is `und` with score 0. Only the text is looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*columns, F.col("text").alias("__text"))

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            n, best = len(texts), sent.value
            lang, score, rate = np.full(n, "und", object), np.zeros(n), np.zeros(n)
            if best is not None and n:
                bits = best.bits(texts)
                pick = bits.argmin(axis=1)
                more = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)
                length = np.diff(raw(texts)[1])
                known = has_letter(texts)
                lang[known] = np.array(best.langs, object)[pick[known]]
                score = np.where(known, 1 / np.exp2(-more).sum(axis=1), 0.0)
                rate = bits.min(axis=1) / np.maximum(length, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score), pa.array(rate)],
                [*batch.schema.names[:-1], "lang_pred", "score", "bits_per_byte"],
            )

    names = docs.select(*columns).schema
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("bits_per_byte", "double")):
        names = names.add(name, kind)
    return source.mapInArrow(run, names)


def held_out() -> Column:
    """Documents kept from learning: crc32(doc_id as text) mod 3 is 1; a row without an id is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def identified(docs: DataFrame) -> DataFrame:
    """The documents in a learned language; those that are `und`, or cost more than texts of their language do, go."""
    # Rows pass through as one column each, so that none of theirs can be taken for one of the prediction.
    models = fit(docs, ~held_out())
    found = predict(docs.select(F.struct(*own(docs)).alias("row"), "text"), models, ("row",))
    known = models.limits.items() if models is not None else ()
    limits = F.create_map(*[F.lit(x) for lang, most in known for x in (lang, most)]) if known else F.create_map(F.lit(""), F.lit(0.0))
    limit = F.least(F.lit(RAW_BITS), SLACK * F.coalesce(limits[F.col("lang_pred")], F.lit(RAW_BITS)))
    return found.where((F.col("lang_pred") != "und") & (F.col("bits_per_byte") < limit)).select("row.*")
