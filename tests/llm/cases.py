"""Small inputs with the awkward rows that every operator has to take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "l", "nd", "")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + ("." if rng.random() < 0.1 else "") for _ in range(n))


def documents(spark, rows, extra=()):
    df = spark.createDataFrame([(r[0], r[1], "en" if len(r) < 3 else r[2], "a" if len(r) < 4 else r[3], len(r[1]) if r[1] is not None else None) for r in rows], SCHEMA)
    from pyspark.sql import functions as F

    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    return df


#: Nulls in every column, empty and blank texts, repeated rows, a doc_id with two texts, other scripts, one long text.
AWKWARD = [
    (None, None, None, None),
    (None, prose(1, 80), "en", None),
    (1, None, None, "a"),
    (2, "", "en", "a"),
    (3, "   \n\t ", "de", "b"),
    (4, "!!! ??? ***", "fr", "b"),
    (5, prose(2, 120), "en", "a"),
    (5, prose(2, 120), "en", "a"),
    (6, prose(3, 90), "en", "a"),
    (6, prose(4, 90), "de", "c"),
    (7, prose(2, 120), "en", None),
    (8, "один два три четыре пять шесть семь восемь девять десять", "ru", "a"),
    (9, "日本語の文章です。" * 30, "ja", "a"),
    (10, prose(5, 20000), "en", "b"),
    (11, "one", "en", "a"),
    (12, "ab ab ab ab " * 200, "en", "a"),
    (-3, prose(6, 60) + "\x00 tail 😀", "en", "a"),
]
#: Names that clash with what the operators use inside.
CLASHING = ("size", "rank", "route", "class_id", "score", "text_hash", "spans", "place", "kept_id", "u", "a", "b", "id", "rate", "guest", "target", "copies", "DOC", "key")


def awkward(spark):
    return documents(spark, AWKWARD, CLASHING)


def empty(spark):
    return documents(spark, AWKWARD).limit(0)
