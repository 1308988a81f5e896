"""Small awkward tables for the operators of the training-data package."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size int, tie string, value string, words string"


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abdehilmnorstuäé") for _ in range(r.randint(1, 7))) for _ in range(n))


def awkward(spark, *extra):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, clashing extra columns."""
    long = words(1, 9000)
    texts = [
        (1, words(2, 120)),
        (2, words(2, 120)),
        (3, words(2, 119) + " changed"),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, long),
        (7, long),
        (8, "one"),
        (8, "another text under the same id"),
        (None, words(3, 80)),
        (None, None),
        (9, "ab" * 700),
        (10, words(4, 30) + "\nline two\n\n" + words(5, 30)),
        (11, "Ünï cödé 😀😀 漢字漢字 <|endoftext|> don't  stop "),
        *extra,
    ]
    rows = [(i, t, "xy" if i and i % 2 else None, None if i == 1 else f"s{(i or 0) % 3}", None, "r", 1, "t", None, "w") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def key(value):
    return [(v is not None, v) for v in value]
