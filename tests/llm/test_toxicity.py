"""Toxicity against a plain learner, on held-out documents, and in odd cases."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tiers.llm import toxicity
from tiers.llm.common import BASE, MASK

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def plain_mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def plain_features(text):
    """Coordinates of a text by the definition, with Python's whole numbers."""
    found = re.findall(rb"[^\x09-\x0d\x20!-/:-@\[-`{-~]+", text.encode())
    hashes = []
    for w in found:
        total = sum(c * pow(BASE, k, 1 << 64) for k, c in enumerate(w.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))))
        hashes.append(plain_mix((total + len(w) * BASE) & MASK))
    step, salts = 0xD6E8FEB86659FD93, [int(s) for s in toxicity._SALTS]
    out = {plain_mix(h ^ salts[0]) for h in hashes}
    out |= {plain_mix(plain_mix((a * step + b) & MASK) ^ salts[1]) for a, b in zip(hashes, hashes[1:], strict=False)}
    out |= {plain_mix(((a * step + b) & MASK) ^ salts[2]) for a, b in zip(hashes, hashes[2:], strict=False)}
    return {x >> 64 - toxicity.BITS for x in out}


def plain_learn(order):
    z, n, w = {}, {}, {}
    own = 1 << toxicity.BITS

    def weight(i):
        held = 0.0 if i == own else toxicity.L1
        if abs(z.get(i, 0.0)) <= held:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + (toxicity.L2 if held else 0.0)
        return -(z[i] - math.copysign(held, z[i])) / rate

    for _ in range(toxicity.EPOCHS):
        for at, y in order:
            w = {i: weight(i) for i in (*at, own)}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - y
            for i in w:
                past = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(past + g * g) - math.sqrt(past)) / toxicity.ALPHA * w[i]
                n[i] = past + g * g
    return {i: weight(i) for i in n if weight(i)}


TEXTS = ["", "a", "One two, THREE two!", "é ß你 x_y 'q'", "a a a a", "tab\tnew\nline " * 40, "w" * 3000, "1 2"]


def test_features_against_plain():
    texts = [*TEXTS, None]
    found = {k: set() for k in range(len(texts))}
    for i, _, row, at in toxicity.features(pa.array(texts)):
        for r, c in zip(row.tolist(), at.tolist(), strict=True):
            assert c not in found[i + r]
            found[i + r].add(c)
    assert [found[k] for k in range(len(texts))] == [plain_features(t or "") for t in texts]


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(900)), "short one", "x" * 9000 + " y z"]
    monkeypatch.setattr(toxicity, "SLICE_BYTES", 256)
    monkeypatch.setattr(toxicity, "WINDOW", 64)
    monkeypatch.setattr(toxicity, "slices", lambda texts: ((k, k + 1) for k in range(len(texts))))
    found = [set(at.tolist()) for _, _, _, at in toxicity.features(pa.array(texts))]
    assert found == [plain_features(t) for t in texts]


def test_learner_against_plain():
    rng = random.Random(2)
    examples = []
    for _ in range(150):
        words = [rng.choice("abcdefghijklmnop") for _ in range(12)]
        y = float("a" in words and rng.random() < 0.95)
        examples.append((rng.getrandbits(60), y, np.array(sorted(plain_features(" ".join(words))), np.int64)))
    key, _, at = examples[5]
    examples += [(key, 1.0, at), (key, 0.0, at)]
    mean = {k: np.mean([y for j, y, _ in examples if j == k]) for k, _, _ in examples}
    order = [(a.tolist(), float(mean[k])) for k, a in sorted({k: a for k, _, a in examples}.items())]
    at, weight = toxicity.learn(examples)
    want = plain_learn(order)
    assert set(at.tolist()) == set(want)
    assert all(w == pytest.approx(want[i], rel=1e-9, abs=1e-12) for i, w in zip(at.tolist(), weight.tolist(), strict=True))


def corpus(rng, n):
    rows = []
    for i in range(n):
        words = [rng.choice(["the", "cat", "sat", "on", "mat", "dog", "ran", "far"]) + str(rng.randrange(30)) for _ in range(rng.randrange(20, 60))]
        bad = i % 6 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "Rotten,", "foul!"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_held_out_documents(spark):
    rows = corpus(random.Random(3), 900)
    docs = spark.createDataFrame([(i, t, None) for i, t, _ in rows], DOCS).withColumn("score", F.lit("clash")).withColumn("label", F.lit("x"))
    odd = spark.createDataFrame([(None, "vile rotten foul", None), (9001, None, None), (9002, "", None), (3, "vile foul", None)], DOCS)
    docs = docs.unionByName(odd, allowMissingColumns=True)
    # Labels that are held out are wrong on purpose: nothing may be learned from them.
    out = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    table = [(i, 1, 1 - y if i in out else y) for i, _, y in rows] + [(None, 1, 1), (5, None, None), (77777, 1, 1)]
    labels = spark.createDataFrame(table, LABELS).withColumn("score", F.lit(0))
    found = toxicity.judged(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    got = found.collect()
    assert len(got) == 904 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {i: y for i, _, y in rows}
    once = [r for r in got if r.doc_id in truth and r.doc_id != 3]
    assert all(r.held_out == (r.doc_id in out) for r in once)
    assert np.mean([r.predicted == truth[r.doc_id] for r in once if r.held_out]) > 0.97
    empty = [r.score for r in got if r.doc_id in (9001, 9002)]
    assert empty[0] == empty[1] < 0.5 and [r.predicted for r in got if r.doc_id is None] == [1]
    assert not [r for r in got if r.doc_id is None][0].held_out
    again = toxicity.judged(docs.repartition(7), labels.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "ROWS_PER_LABEL", 100)
    seen = []
    drawn = toxicity._drawn
    monkeypatch.setattr(toxicity, "_drawn", lambda rows, *key: seen.append(drawn(rows, *key)) or seen[-1])
    rows = corpus(random.Random(4), 600)
    shared = [(1, t, None) for _, t, _ in corpus(random.Random(5), 1500)]  # one id for many texts
    docs = spark.createDataFrame([(i, t, None) for i, t, _ in rows] + shared, DOCS)
    model = toxicity.fit(docs, spark.createDataFrame([(i, 0, y) for i, _, y in rows], LABELS), F.lit(True))
    assert model is not None and seen[-1][0].count() <= 300


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, None)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert [(r.score, r.predicted) for r in toxicity.judged(docs, none).collect()] == [(0.0, 0)] * 2
    strangers = spark.createDataFrame([(50, 1, 1), (51, 1, 0)], LABELS)
    assert [r.score for r in toxicity.judged(docs, strangers).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert all(r.score < 0.5 for r in toxicity.judged(docs, one).collect())
    assert toxicity.judged(docs.where("false"), one).count() == 0
