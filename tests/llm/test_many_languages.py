"""Language identification without a limit on languages, on rows without ids, and against a plain PPM."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tiers.llm import langid

DOCS = "doc_id long, text string, lang string"


def plain_cost(texts, text):
    """Bits of a text under the texts of a language: contexts of up to three bytes, escape to the shorter by exclusion."""
    after = [defaultdict(Counter) for _ in range(4)]
    for t in texts:
        b = b"   " + t.encode()
        for i in range(3, len(b)):
            for k in range(4):
                after[k][b[i - k : i]][b[i]] += 1
    total, b = 0.0, b"   " + text.encode()
    for i in range(3, len(b)):
        past = b[i - 3 : i]

        spread = np.full(256, 1 / 256)
        for k in range(4):
            # Contexts of two and three bytes count from two sightings on.
            seen = after[k][past[3 - k :]]
            n, kinds = sum(seen.values()), len(seen)
            if n < (2 if k > 1 else 1):
                break
            new = np.zeros(256, bool)
            new[list(seen)] = True
            escape = kinds / (n + kinds) / spread[~new].sum()
            spread = np.array([seen[s] / (n + kinds) if new[s] else escape * spread[s] for s in range(256)])
        total -= np.log2(spread[b[i]])
    return total


def test_costs_against_a_plain_ppm():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcde ") for _ in range(60)) for _ in range(3)]
    sample = pa.array(texts)
    grams = Counter()
    for t in texts:
        b = b"   " + t.encode()
        grams.update(int.from_bytes(b[i - 3 : i + 1]) for i in range(3, len(b)))
    model = langid.build(["x"], np.zeros(len(grams), int), np.array(list(grams)), np.array(list(grams.values())))
    probes = [texts[0][:20], "abc dea", "zz top"]
    found = model.bits(pa.array(probes))[:, 0]
    assert found == pytest.approx([plain_cost(texts, p) for p in probes], rel=1e-4)
    assert len(sample) == 3


def words_of(lang):
    rng = random.Random(lang)
    return ["".join(rng.choice("bcdfghjklmnpqrstvwxyzaeiou") for _ in range(rng.randrange(3, 8))) for _ in range(25)]


def test_all_of_150_languages_are_learned(spark):
    rng, rows = random.Random(2), []
    for lang in range(150):
        words = words_of(lang)
        rows += [(len(rows) + i, " ".join(rng.choice(words) for _ in range(40)), f"l{lang:03d}") for i in range(8)]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.fit(docs, ~langid.held_out())
    assert len(model.langs) == 150 and len(model.tables) == 19 and set(model.limits) == set(model.langs)
    found = langid.predict(docs.where(langid.held_out()), model, ("doc_id", "lang")).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.97


def test_rows_without_an_id_are_sampled_too(spark, monkeypatch):
    monkeypatch.setattr(langid, "DOCS_PER_LANG", 50)
    rows = [(None, f"text number {i}", "en") for i in range(2000)] + [(i, f"other text {i}", "en") for i in range(2000)]
    drawn = langid.learnable(spark.createDataFrame(rows, DOCS), F.lit(True)).count()
    assert 20 <= drawn <= 90


def test_texts_that_cost_more_than_any_of_their_language_go(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(words_of(1)) for _ in range(50)), "aa") for i in range(60)]
    rows += [(100, "QXZ 9#7% ÿþ QJZ 0@1! WVK ~^| " * 5, "aa")]
    learned = spark.createDataFrame(rows[:60], DOCS)
    model = langid.fit(learned)
    assert 0 < model.limits["aa"] < langid.RAW_BITS
    kept = {r.doc_id for r in langid.identified(spark.createDataFrame(rows[:60] + [(101, rows[60][1], None)], DOCS)).collect()}
    assert 101 not in kept and len(kept) == 60
