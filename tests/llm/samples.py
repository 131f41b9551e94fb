"""Small tables with the awkward rows that every operator has to stand."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} and" for i in range(60_000))

#: (doc_id, text): nulls, empty and blank texts, one very long, repeated rows, an id with two texts
AWKWARD = [
    (None, "a text without an id\nsecond\nthird\nfourth"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, LONG),
    (5, "one two three four five six seven\nline\nline\nline\nline"),
    (5, "one two three four five six seven\nline\nline\nline\nline"),
    (6, "first of two"),
    (6, "second of two"),
    (7, "ünïcödé 😀 wörds ﬁ ١٢٣"),
]

#: names that operators use inside, or return
CLASHING = ("row", "document", "lines", "covered", "text_hash", "found", "score", "n_hit", "spans", "blob_id", "label", "digest", "fingerprint")


def documents(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({name: F.lit(f"own {name}") for name in CLASHING}) if clashing else df


def invented(seed: int, count: int, words: int = 60, alphabet: int = 400) -> list[str]:
    draw = random.Random(seed)
    lexicon = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyzäöé") for _ in range(draw.randint(1, 9))) for _ in range(alphabet)]
    return [" ".join(draw.choice(lexicon) for _ in range(draw.randint(1, words))) for _ in range(count)]
