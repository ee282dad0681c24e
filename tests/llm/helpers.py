"""Small tables that hold every awkward case at once."""

import random

from pyspark.sql import DataFrame, SparkSession

_random = random.Random(0)
LONG = " ".join(f"w{i % 977}" for i in range(40_000)) + "\n" + "".join(_random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000)) + " " + "x" * 20_000
CASES = [
    (1, "plain words stand here, and more of them follow.\nSecond line of it."),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, LONG),
    (6, "plain words stand here, and more of them follow.\nSecond line of it."),
    (6, "plain words stand here, and more of them follow.\nSecond line of it."),
    (None, "a row without an id"),
    (None, None),
    (8, "Éàü 你好 😀 \x00 <|endoftext|> </turn> \\l \\"),
]


def cases(spark: SparkSession) -> DataFrame:
    """The cases, with columns whose names the operators might use themselves."""
    rows = [(i, t, "en", i, f"k{n}", n, 1.0, "h", 7) for n, (i, t) in enumerate(CASES)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id long, key string, fp int, score double, row string, places int")


def empty(spark: SparkSession) -> DataFrame:
    return cases(spark).limit(0)
