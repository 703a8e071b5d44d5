"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

AWKWARD = [
    (1, None, "en", "a", 0),
    (2, "", None, "a", 0),
    (3, " \t\n ", "en", None, 4),
    (None, "idiot words of nobody " * 20, "en", "b", 0),
    (4, "one two three four", "en", "b", 18),
    (4, "one two three four", "en", "b", 18),
    (4, "another text with the same id " * 5, "en", "b", 18),
    (5, "a a a a a a a a a a a a a a a a", "en", "", 30),
    (6, "Released under the MIT License.\x00\x01 Éa\u0130 \U0001f469\u200d\U0001f469", "en", "c", 9),
    (7, "word " * 30_000, "en", "c", 150_000),
    (8, " ".join(f"w{i}" for i in range(60)), "en", "c", 9),
    (9, "x " + " ".join(f"w{i}" for i in range(60)), "en", "c", 9),
    (-3, "minus three", "en", "d", 11),
]

CLASHES = ("row", "size", "target", "src", "batch", "score", "digest", "label", "key", "held_out", "part", "id")


def documents(spark: SparkSession, rows=AWKWARD) -> DataFrame:
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.withColumns({c: F.lit(c) for c in CLASHES})


def invented(n: int, seed: int, copies: int = 3, words: int = 60) -> list[tuple]:
    """Documents of invented words, some with near copies and shared passages."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("aeinrst") for _ in range(draw.randint(1, 4))) for _ in range(400)]
    passage = [draw.choice(vocabulary) for _ in range(20)]
    rows = []
    for i in range(n):
        text = [draw.choice(vocabulary) for _ in range(draw.randint(1, words))]
        if draw.random() < 0.3:
            text[len(text) // 2 : len(text) // 2] = passage[draw.randint(0, 6) :]
        rows.append(text)
        for _ in range(draw.randint(0, copies) if draw.random() < 0.3 else 0):
            near = list(text)
            for _ in range(draw.randint(0, 3)):
                near[draw.randrange(len(near))] = draw.choice(vocabulary)
            rows.append(near)
    draw.shuffle(rows)
    return [(i, " ".join(t), "en", f"s{i % 3}", 0) for i, t in enumerate(rows)]
