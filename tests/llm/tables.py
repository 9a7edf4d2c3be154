"""Small tables with the awkward rows that every operator must take."""

import random

from pyspark.sql import functions as F

#: Names that operators use for their own columns.
CLASHES = ["_key", "_text", "_row", "_set", "_n", "size", "shard", "ids", "row", "kept", "toxicity", "host", "score", "_node"]


def crowded(df):
    """``df`` with further columns whose names clash with those of the operators."""
    return df.select("*", *(F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHES)))


def words(seed: int, count: int, vocabulary: int = 400) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(count))


def awkward_texts() -> list[tuple]:
    """(doc_id, text): nulls, empty, blank and very long texts, copies, repeated rows, a null id."""
    long = "\n".join(words(i, 60) for i in range(400))
    rows = [(i, words(i, 30 + i % 50) + "\n" + words(i % 3, 12)) for i in range(40)]
    return [
        *rows,
        (40, None),
        (41, ""),
        (42, " \t \n "),
        (43, long),
        (44, "x" * 60_000),
        (45, rows[3][1]),
        (46, rows[3][1]),
        (5, rows[5][1]),
        (None, rows[3][1]),
        (None, None),
        (47, "Ünï <|endoftext|> é́ 's\x1c b　c \U0001f600\r\n"),
        (48, "one two"),
    ]


def documents(spark, rows=None):
    return spark.createDataFrame(awkward_texts() if rows is None else rows, "doc_id long, text string").repartition(3)
