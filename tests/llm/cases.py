"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ta ro mi ken sol ba dur fi lop ne gra wi zu hem tic var".split()


def prose(words: int, seed: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(words)]
    lines, at = [], 0
    while at < words:
        n = rng.randint(5, 60)
        lines.append(" ".join(made[at : at + n]).capitalize() + ".")
        at += n
    return "\n".join(lines)


def rows() -> list[tuple]:
    a, b = prose(400, 1), prose(300, 2)
    passage = prose(70, 3).replace("\n", " ")
    made = [
        (1, a, "en", "web", len(a)),
        (2, b, "en", "web", len(b)),
        (3, a, "en", "books", len(a)),  # an exact copy
        (4, a.replace("Ta", "Xx", 1) + " end", "en", None, len(a)),  # a near copy
        (5, b + "\n" + passage, "fr", "books", 0),
        (6, prose(120, 4) + "\n" + passage + "\n" + prose(90, 5), None, "web", None),
        (7, None, None, None, None),
        (8, "", "en", "web", 0),
        (9, " \t\n\r ", "en", "web", 5),
        (10, "One", "en", "notes", 3),
        (11, "one two", "en", "notes", 7),
        (12, "ONE TWO", "en", "notes", 7),
        (13, prose(20_000, 6), "de", "web", 1),  # very long
        (14, "x" * 30_000, "en", "web", 30_000),  # one very long word
        (15, "éàü ́ ß İ ﬁ 漢字 😀 <|endoftext|> it's  two   gaps \x1cz", "fr", "web", 1),
        (16, "again\n" * 400, "en", "web", 1),
        (16, "again\n" * 400, "en", "web", 1),  # a repeated row
        (17, b, "en", "web", len(b)),
        (None, prose(30, 7), "en", "web", 1),
        (None, prose(30, 7), "en", "web", 1),
    ]
    return made + [(100 + i, prose(20 + 7 * i, 50 + i), "en", ("web", "books", "notes")[i % 3], 1) for i in range(40)]


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def clashing(docs: DataFrame, names: str) -> DataFrame:
    """``docs`` with extra columns of the given names."""
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("extra").alias(n) for n in names.split()])


def texts() -> dict:
    """Text by doc_id for the rows that have one; NULL as empty."""
    return {r[0]: r[1] or "" for r in rows() if r[0] is not None}
