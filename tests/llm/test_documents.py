"""Operators on documents against plain versions on small tables, and their odd cases."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tiers.llm import common, decontaminate, langid, mixing, simhash, substring

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, stem="w"):
    return " ".join(f"{stem}{rng.randrange(400)}" for _ in range(n))


def docs_of(spark, texts, lang="en"):
    rows = [(i, t, lang, f"s{(i or 0) % 3}", None if t is None else len(t)) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def odd(rng):
    """NULLs, empty and long texts, repeated rows."""
    long = prose(rng, 30_000)
    return [(1, None), (2, ""), (3, " \n\t"), (4, long), (5, "one"), (5, "one"), (None, "no id here"), (6, "é ß 你好"), (7, "12 34 5")]


def test_words_do_not_cross_rows():
    data, at = common.raw(pa.array(["ab c", None, "", "d  e\x0bf", "g"]))
    begin, end, row = common.words(data, at, common.space_table())
    found = [(int(r), bytes(data[b:e]).decode()) for b, e, r in zip(begin, end, row, strict=True)]
    assert found == [(0, "ab"), (0, "c"), (3, "d"), (3, "e"), (3, "f"), (4, "g")]
    hashed = common.word_hashes(data, begin, end)
    assert len(set(hashed.tolist())) == 6


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    found = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert all(found.get(x, x) == top(x) for x in root)
    assert common.components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def plain_fingerprint(text):
    found = (text or "").encode().lower().split()
    shingles = [b" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or ([b" ".join(found)] if found else [])
    value = 0
    for bit in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles) > len(shingles):
            value |= 1 << bit
    return value


@pytest.mark.parametrize("crowd", [1, 64])
def test_simhash_against_all_pairs(spark, crowd):
    rng = random.Random(5)
    texts = odd(rng)
    base = prose(rng, 300).split()
    for i in range(100, 160):
        near = list(base)
        near[rng.randrange(300)] = "changed"
        texts.append((i, " ".join(near)))
    texts += [(i, prose(rng, 40)) for i in range(200, 240)]
    rows = simhash.near_duplicates(docs_of(spark, texts), crowd).collect()
    assert len(rows) == len(texts)
    prints = sorted({plain_fingerprint(t) for _, t in texts})
    group = {p: p for p in prints}
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2 and group[a] != group[b]:
                old, new = group[b], group[a]
                group = {k: new if v == old else v for k, v in group.items()}
    first = defaultdict(list)
    for i, t in texts:
        if i is not None:
            first[group[plain_fingerprint(t)]].append(i)
    wanted = sorted((str(i), f"{plain_fingerprint(t):016x}", str(min(first[group[plain_fingerprint(t)]], default=None))) for i, t in texts)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == wanted


def test_one_of_each_keeps_one(spark):
    docs = docs_of(spark, [(1, "a b c d"), (2, "A b c d"), (3, "other words here now"), (3, "other words here now"), (None, "some more text"), (4, None), (5, "")])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "None"]
    assert simhash.one_of_each(empty(spark)).count() == 0


def test_code_lengths_are_a_code_and_tell_languages(spark):
    rng = random.Random(7)
    kinds = {"aa": "ka lo mi tu", "bb": "sche ung ich der"}
    texts = []
    for i in range(120):
        lang = ("aa", "bb")[i % 2]
        parts = kinds[lang].split()
        texts.append((i, " ".join("".join(rng.choices(parts, k=2)) for _ in range(30)), lang))
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("x"))
    model = langid.fit(docs, ~langid.held_out())
    share = np.ones(model.cost.shape[1])
    share[-1] = 256 - model.cost.shape[1] + 1
    assert np.allclose((2.0 ** -model.cost.astype(float) * share[None, :, None]).sum(axis=1), 1, atol=1e-4)
    found = {r.doc_id: r for r in langid.predict(docs, model, ("doc_id", "lang")).collect()}
    held = [r for i, t, _ in texts for r in [found[i]] if __import__("zlib").crc32(str(i).encode()) % 3 == 1]
    assert held and all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in held)


def test_bits_do_not_depend_on_batches():
    texts = pa.array(["kalo mitu", "", None, "x" * 3_000_000, "ungder é"])
    grams = np.array([32 << 24 | 32 << 16 | 32 << 8 | 107, 107 << 24 | 97 << 16 | 108 << 8 | 111])
    model = langid.build(["aa"], np.zeros(2, int), grams, np.array([5, 7]))
    whole = model.bits(texts)
    assert np.allclose(whole, np.concatenate([model.bits(texts.slice(i, 1)) for i in range(5)]), rtol=1e-6)
    assert whole[1, 0] == whole[2, 0] == 0


def test_language_odd_cases(spark):
    docs = docs_of(spark, odd(random.Random(1)))
    model = langid.fit(docs)
    found = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, model, ("doc_id",)).collect()]
    assert len(found) == 9
    assert all((p == "und") == (s == 0) for _, p, s in found)
    assert {i for i, p, _ in found if p == "und"} == {1, 2, 3, 7}
    none = langid.predict(docs, langid.fit(empty(spark)), ("doc_id",))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert langid.identified(empty(spark)).count() == 0


def covered(spans, begin, end):
    return any(a <= begin and end <= b for a, b in spans)


def test_repeated_passages_are_found_and_cut(spark):
    rng = random.Random(11)
    shared = prose(rng, 60, "s")
    edited = shared.split()
    edited[20] = "other"
    edited.insert(35, "more")
    common_line = prose(rng, 70, "line")
    texts = [(i, prose(rng, 200, f"d{i}x")) for i in range(10)]
    texts += [(20, texts[0][1] + " " + shared + " " + prose(rng, 50, "t")), (21, prose(rng, 80, "u") + " " + shared), (22, " ".join(edited))]
    texts += [(i, prose(rng, 30, f"e{i}x") + "\n" + common_line + "\n" + prose(rng, 30, f"f{i}x")) for i in range(30, 70)]
    texts += [(80, "for " * 200), (81, "for " * 150), *odd(rng)]
    docs = docs_of(spark, texts)
    found = defaultdict(list)
    for r in substring.passages(docs).collect():
        assert r.source_id < r.doc_id and r.similarity >= 0.8 and r.words >= 50
        found[r.doc_id].append((r.begin, r.begin + r.words))
    assert covered(found[20], 0, 200) and covered(found[21], 80, 140) and covered(found[22], 0, 61)
    assert all(covered(found[i], 30, 100) for i in range(31, 70)) and 30 not in found
    assert covered(found[81], 0, 150)
    assert not set(range(10)) & set(found)
    kept = {r.doc_id: r for r in substring.without_repeats(docs).collect()}
    assert 22 not in kept and 81 not in kept and 80 in kept
    assert common_line not in kept[31].text and common_line in kept[30].text
    assert kept[31].n_chars == len(kept[31].text)
    assert kept[4].text == dict(texts[-9:])[4] and kept[1].text is None
    assert substring.passages(empty(spark)).count() == 0 and substring.without_repeats(empty(spark)).count() == 0


def test_best_chain_against_all_chains():
    rng = random.Random(2)
    for _ in range(60):
        points = sorted({(rng.randrange(40), rng.randrange(40)) for _ in range(8)})
        word, place = map(np.array, zip(*points, strict=True))
        value = {}
        for i, (w, p) in enumerate(points):
            value[i] = max([substring.K] + [value[j] + substring.K - substring.GAP * (w - a + p - b) for j, (a, b) in enumerate(points[:i]) if a < w and b < p])
        best = substring.best_chains(word, place)[0]
        got = substring.K * len(best) - substring.GAP * (word[best[-1]] - word[best[0]] + place[best[-1]] - place[best[0]])
        assert abs(got - max(value.values())) < 1e-9


def test_alignment_against_a_plain_table():
    rng = random.Random(4)
    for _ in range(40):
        a = np.array([rng.randrange(5) for _ in range(rng.randrange(1, 12))], np.uint64)
        b = np.array([rng.randrange(5) for _ in range(rng.randrange(1, 15))], np.uint64)
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        best, _ = common.local_alignment([a, a[:0]], [b, b], 2, 1, 1)
        assert best.tolist() == [h.max(), 0]


def test_leaks(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, 30, f"q{i}x")) for i in range(6)] + [(6, "of the and"), (7, "two words"), (8, None), (0, None)]
    edited = items[1][1].split()
    edited[5], edited[12], edited[20] = "other", "words", "here"
    texts = [(i, prose(rng, 120)) for i in range(50)]
    texts += [(60, prose(rng, 40) + " " + items[0][1].upper() + ". " + prose(rng, 40)), (61, " ".join(edited)), (62, " ".join(items[2][1].split()[:8]))]
    texts += [(i, prose(rng, 20) + " " + items[3][1]) for i in range(100, 300)] + odd(rng)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(spark, texts).withColumn("passage", F.lit(1))
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(docs, benchmark).collect()}
    assert set(found) == {(60, 0), (61, 1), *((i, 3) for i in range(100, 300))}
    assert found[60, 0] == 1 and 0.7 < found[61, 1] < 1
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(texts) - len(found)
    assert decontaminate.leaks(empty(spark), benchmark).count() == 0
    assert decontaminate.clean(docs, benchmark.where("false")).count() == len(texts)


def test_mix_reaches_targets(spark):
    rng = random.Random(9)
    texts = [(i, prose(rng, rng.randrange(1, 60))) for i in range(400)] + odd(rng)
    rows = [(i, t, "en", None if k % 7 == 0 else f"s{min(k % 5, 2)}", 0) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash"))
    found = mixing.mixed(docs).collect()
    assert len(found) == len(rows) and all(0 <= r.taken <= 3 * r["size"] for r in found)
    by = defaultdict(list)
    for r in found:
        by[r.source_size, r.target].append(r.taken)
    assert all(abs(sum(v) - t) <= 1 for (_, t), v in by.items())
    assert abs(sum(t for _, t in by) - sum(r["size"] for r in found)) < 1e-6
    again = mixing.mixed(docs.repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert mixing.mixed(empty(spark)).count() == 0
    whole = mixing.mixed(docs, texts=True)
    assert sorted((str(r.doc_id), r.taken) for r in whole.collect()) == sorted((str(r.doc_id), r.taken) for r in found)


def test_targets_and_flow():
    assert mixing.targets({"a": 10, "b": 10, None: 100}) == {"a": 22.5, "b": 30.0, None: 67.5}
    # 60 words in a, 30 in both, 30 in b; b wants more than it has alone, so the overlap goes to b first.
    sent = mixing.flow([60, 30, 30], [["a"], ["a", "b"], ["b"]], {"a": 60, "b": 60})
    assert sent == [60, 30, 30]
    assert mixing.flow([10], [["a"]], {"a": 100}) == [30]
    assert mixing.flow([10, 10], [["a"], ["a"]], {"a": 30}) in ([20, 10], [10, 20])


def test_overlapping_sources(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 20), ["a"] if i % 3 else ["a", "b"]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, of array<string>")
    found = mixing.mixed(docs, F.col("of")).collect()
    assert len(found) == 60 and all(r.taken <= 3 * r["size"] for r in found)
