"""Documents that every operator must handle, and plain versions of what several operators compute."""

from __future__ import annotations

import random

from pyspark.sql import types as T

# Extra columns whose names clash with those of results and of working tables, in any case.
CLASHING = ["Text", "ids", "digest", "row", "lane", "node", "kept", "score", "n_tokens", "class_id", "text_key", "c1"]

LONG = " ".join(f"word{i % 977} and{i}" for i in range(20_000))
SENTENCE = "one two three four five six seven eight nine ten"

TEXTS = [
    (1, SENTENCE),
    (2, SENTENCE),
    (2, SENTENCE),
    (3, " one\ttwo three\nfour five six  seven eight nine ten \r\n"),
    (4, ""),
    (5, None),
    (None, "a text without an id"),
    (None, None),
    (6, LONG),
    (7, "x"),
    (8, "é́ ünïcode 日本語 🤦🏼‍♂️ <|endoftext|> <|startoftext|>"),
    (9, " \n\t\r\x0b\x0c "),
    (-10, "It's WE'LL  I'd.\n\n\nSecond   line\n"),
    (2**62, "a" * 5_000),
    (11, "\x00\x1f control   and　wide spaces \x85 \x1c"),
]


def documents(spark, rows, extra=()):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    fields += [T.StructField(name, T.StringType()) for name in extra]
    values = [(*row, *(None if i % 2 else "extra" for i in range(len(extra)))) for row in rows]
    return spark.createDataFrame(values, T.StructType(fields))


def edge_documents(spark):
    return documents(spark, TEXTS, CLASHING)


def prose(seed: int, n: int, vocabulary: int = 3_000) -> str:
    generator = random.Random(seed)
    return " ".join(f"w{generator.randrange(vocabulary)}" for _ in range(n))


def near_copy(text: str, seed: int, changes: int) -> str:
    generator, words = random.Random(seed), text.split()
    for place in generator.sample(range(len(words)), changes):
        words[place] = f"changed{generator.randrange(10**6)}"
    return " ".join(words)
