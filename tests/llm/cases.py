"""Documents that try the operators: prose, copies, edits, nulls, empty, long, repeated."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
)


def prose(rng, n, vocabulary=None):
    vocabulary = vocabulary or ["".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(2, 9))) for _ in range(400)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def edited(rng, text, share):
    return " ".join("x" + w if rng.random() < share else w for w in text.split(" "))


def texts(seed=1):
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(30, 300)) for _ in range(12)]
    passage = prose(rng, 60)
    out = list(base)
    out += [base[0], base[0], base[1].upper(), edited(rng, base[2], 0.01), edited(rng, base[2], 0.02), edited(rng, base[3], 0.3)]
    out += [base[4] + "\n" + passage, passage + "\n" + base[5], base[6][:40] + passage + base[7]]
    out += [None, "", " \t\n", "word", "two words", "É à ß 漢字 😀", "a" * 5000, "ab" * 300, "Ein. " * 200, "\x1c    x"]
    out += [prose(rng, 20000)]
    return out


def documents(spark, more=(), seed=1):
    rows = [(i * 3 + 1, t, "en" if i % 3 else None, f"s{i % 4}") for i, t in enumerate(texts(seed))]
    return spark.createDataFrame(rows + list(more), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# A row with the id of another, a row like another, and rows without an id.
ODD = [(4, "other text under a used id " * 4, "en", "s1"), (7, None, None, None), (7, None, None, None), (None, "no id here " * 12, "en", None), (None, None, None, None)]
