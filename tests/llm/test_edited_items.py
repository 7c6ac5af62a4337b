"""Benchmark items under edits: what plain alignment of all pairs finds is found by the seeds too."""

import random

import numpy as np
import pytest

from tiers.llm import common, decontaminate


def plain_score(item, text):
    a, b = (np.array([hash(w) & ((1 << 63) - 1) for w in x], np.uint64) for x in (item, text))
    best, _ = common.local_alignment([a], [b], decontaminate.MATCH, decontaminate.MISMATCH, decontaminate.GAP)
    return best[0] / (decontaminate.MATCH * len(item))


def edited(rng, item, rate):
    """Words replaced, put in and taken out at random."""
    out = []
    for i, w in enumerate(item):
        kind = rng.random() / rate if rate else 9
        out += [w] if kind > 1 else [f"new{rng.randrange(10**9)}"] if kind < 0.5 else [w, f"more{rng.randrange(10**9)}"] if kind < 0.75 else []
    return out


def found(spark, items, texts):
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    return {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(docs, benchmark).collect()}


def prose(rng, n):
    return [rng.choice(COMMON) if rng.random() < 0.5 else f"w{rng.randrange(3000)}" for _ in range(n)]


COMMON = "the of and to in a is that it was for on as with by".split()


@pytest.mark.parametrize("least", [0.5, 0.6, 0.7, 0.8])
def test_recall_against_plain_alignment(spark, least):
    rng = random.Random(int(least * 10))
    items = [prose(rng, rng.randrange(14, 50)) for _ in range(60)]
    texts, pairs = [], []
    for k, item in enumerate(items):
        for rate in (0, 0.1, 0.2, 0.3, 0.4):
            texts.append(prose(rng, 80) + edited(rng, item, rate) + prose(rng, 80))
            pairs.append((len(texts) - 1, k))
    texts += [prose(rng, 300) for _ in range(100)]
    got = found(spark, items, texts)
    wanted = [(d, k) for d, k in pairs if plain_score(items[k], texts[d]) >= least]
    hit = [p for p in wanted if got.get(p, 0) >= least]
    assert len(wanted) > 100 and len(hit) >= 0.98 * len(wanted)
    assert all(got[p] == pytest.approx(plain_score(items[p[1]], texts[p[0]])) for p in hit)
    assert not [p for p in got if p[0] >= len(pairs)]  # clean texts are left alone


@pytest.mark.parametrize("every", [3, 4, 5])
def test_evenly_edited_items(spark, every):
    rng = random.Random(every)
    items = [[f"i{k}x{i}" for i in range(24)] for k in range(20)]
    changed = [[f"e{k}x{i}" if i % every == 2 else w for i, w in enumerate(item)] for k, item in enumerate(items)]
    texts = [prose(rng, 50) + c + prose(rng, 50) for c in changed]
    assert set(found(spark, items, texts)) >= {(k, k) for k in range(20)}


def test_a_word_put_in_between_all_words(spark):
    item = [f"i{k}" for k in range(20)]
    text = [w for k, x in enumerate(item) for w in (x, f"n{k}")][:-1]
    assert plain_score(item, text) >= 0.5 and (0, 0) in found(spark, [item], [["before"] * 5 + text + ["after"] * 5])


def test_items_of_one_and_two_words(spark):
    items = [["paris"], ["forty", "two"], ["no", "way", "out"]]
    texts = [["Paris"], ["paris", "is", "a", "city"], ["forty", "two"], ["two", "forty"], ["forty", "two", "more"], ["there", "is", "no", "way", "out"], []]
    assert set(found(spark, items, texts)) == {(0, 0), (2, 1), (5, 2)}


def test_an_item_copied_into_most_documents(spark):
    rng = random.Random(9)
    items = [prose(rng, 30), prose(rng, 30)]
    texts = [prose(rng, 20) + items[0] + prose(rng, 20) for _ in range(300)] + [prose(rng, 60) for _ in range(100)]
    texts.append(prose(rng, 30) + edited(rng, items[0], 0.2))
    got = found(spark, items, texts)
    assert {d for d, _ in got} == {*range(300), 400} and {k for _, k in got} == {0}
