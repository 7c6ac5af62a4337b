"""Language identification learns from every learnable row and the whole of its text (finding F3 of round 3)."""

import random
import zlib

from tiers.llm import langid

DOCS = "doc_id long, text string, lang string"


def words_of(seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("bcdfghjklmnpqrstvwxyzaeiou") for _ in range(rng.randrange(3, 8))) for _ in range(25)]


def test_what_follows_ten_thousand_characters_is_learned(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(words_of(1)) for _ in range(60)), "aa") for i in range(6)]
    # Texts of bb show their words only after 12,000 characters of padding that no query text has.
    rows += [(10 + i, "x" * 12_000 + " " + " ".join(rng.choice(words_of(2)) for _ in range(60)), "bb") for i in range(6)]
    model = langid.fit(spark.createDataFrame(rows, DOCS))
    query = [(100, " ".join(rng.choice(words_of(2)) for _ in range(40)), None)]
    found = langid.predict(spark.createDataFrame(query, DOCS), model, ("doc_id",)).collect()
    assert found[0].lang_pred == "bb"


def test_every_learnable_row_counts(spark):
    rows = [(i, f"row {i} says hello", "en") for i in range(1500)]
    counted = langid.count_contexts(langid.learned(spark.createDataFrame(rows, DOCS), ~langid.held_out()))
    # "   r" starts every text once: every learnable row of the 1,500 is counted.
    start = (langid.BEFORE << 24) | (langid.BEFORE << 16) | (langid.BEFORE << 8) | ord("r")
    learnable = sum(1 for i in range(1500) if zlib.crc32(str(i).encode()) % 3 != 1)
    assert counted.where(f"gram = {start}").first().n == learnable
