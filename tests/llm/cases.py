"""Awkward inputs that every operator must take: nulls, empty and long texts, ties, repeated rows,
no rows at all, and extra columns named like the operators' own."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["id", "td", "key", "n", "component", "shard", "digest", "spans", "row", "words", "at", "grp", "total", "size"]
SF = "/root/testdata/sf0.001"


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(n))


def awkward_rows() -> list[tuple]:
    long = words(1, 30_000)
    passage = words(2, 60)
    rows = [
        (1, None, "en", "s", None),
        (2, "", "en", "s", 0),
        (3, "one two", "en", None, 7),
        (4, "one two", None, "s", 7),
        (5, long, "en", "s", len(long)),
        (6, long + " tail", "en", "t", len(long) + 5),
        (7, passage + " " + words(3, 40), "en", "t", 0),
        (8, words(4, 40) + " " + passage, "en", "t", 0),
        (9, "é" * 150 + " " + "ü" * 130, "fr", "t", 281),
        (10, "x" * 500, "en", "u", 500),
        (11, "   \n\t ", "en", "u", 6),
        (None, "no id here", "en", "u", 10),
        (None, None, None, None, None),
        (12, "same id " + words(5, 20), "en", "u", 1),
        (12, "same id " + words(6, 20), "en", "u", 1),
        (13, words(7, 50), "en", "u", 1),
        (13, words(7, 50), "en", "u", 1),
    ]
    return rows


def awkward(spark, clashing: bool = True):
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    if clashing:
        from pyspark.sql import functions as F

        for name in CLASHING:
            df = df.withColumn(name, F.lit(name))
    return df


def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
