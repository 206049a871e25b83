"""Small tables shared by the operator tests."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
_RNG = random.Random(7)
WORDS = ["".join(_RNG.choice("bcdfglmnprst") + _RNG.choice("aeiou") for _ in range(_RNG.randint(1, 4))) for _ in range(400)]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents(spark, rows):
    """(doc_id, text[, lang[, source]]) rows as a documents table."""
    full = [(*r, *(None,) * (4 - len(r))) for r in rows]
    return spark.createDataFrame([(i, t, la, s, len(t) if t else 0) for i, t, la, s in full], SCHEMA)


def odd_documents():
    """Null in every column, empty, blank, one word, very long, exact copies, ties, repeated rows."""
    long = prose(1, 60_000)
    return [
        (None, prose(2, 30), "en", "a"), (1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "en", "b"),
        (4, "word", "de", "b"), (5, long, "en", "a"), (6, prose(3, 40), "de", "a"), (7, prose(3, 40), "de", None),
        (8, prose(4, 40), "en", "c"), (8, prose(4, 40), "en", "c"), (9, prose(4, 39) + " other", "en", "c"),
        (10, "Ünïcödé ÇA 😀 日本語 " + prose(5, 12), "fr", "ü"),
    ]


def shingle_set(text, width=3):
    """Word shingles by plain Python."""
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def clashing(df):
    """Extra columns whose names results or helpers use."""
    names = [
        "size", "score", "votes", "keep", "items", "spans", "n_words", "contaminated", "taken", "target", "copies",
        "shard", "slot", "law", "lang_pred", "rejected", "held_out", "h", "_n", "_copy", "n_entities", "_hash", "_kept",
    ]
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in names])
