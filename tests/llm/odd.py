"""Rows that every operator on documents has to take: nulls, empty and long texts, repeats, clashes."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = """doc_id long, text string, lang string, source string, n_chars long, start long,
fingerprint string, score double, ids array<int>, word string, row_id string, u long, v long"""
LONG = "thanouble reanding of the " * 4000
TEXTS = [
    (1, "The cat sat on the mat, and the dog sat there too."),
    (2, "The cat sat on the mat, and the dog sat there too."),
    (3, ""),
    (4, None),
    (5, "   \t\n "),
    (6, "été ça  où là naïve 日本語 🙂 it's don't 's"),
    (7, LONG),
    (8, "x"),
    (9, "a" * 70_000),
    (None, "no id here at all"),
    (10, "The cat sat on the mat, and the dog sat there too."),
    (10, "The cat sat on the mat, and the dog sat there too."),
    (11, "1234 5678 !!! ??? ###"),
]


def odd_documents(spark: SparkSession) -> DataFrame:
    rows = [
        (i, t, None if (i or 0) % 3 == 0 else "en", None, None, -1, "x", 0.5, [1], "w", "r", 1, 2)
        for i, t in TEXTS
    ]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
