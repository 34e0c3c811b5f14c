"""Documents that every operator must survive."""

import random
import re

from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(60_000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, id long, digest string, "
    "label int, words string, spans string, lang_pred string, n_words string"
)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.randrange(vocabulary)}n" for _ in range(n))


def rows():
    a, b = prose(1, 80), prose(2, 120)
    texts = [
        (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "one", "de"), (5, "one two three", "de"), (6, LONG, "en"),
        (7, a, "en"), (8, a, None), (9, a + " tail", "en"), (10, b, "fr"), (11, b.replace(" ", "  ", 5), "fr"),
        (12, "!!! ### 123 456", "es"), (13, "ünï çödé 日本語 🙂 " * 20, "de"), (None, a, "en"), (14, a, "en"), (14, a, "en"),
        (15, prose(3, 70) + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ' + prose(4, 30), "en"),
        (16, "<|endoftext|> " + prose(5, 60) + "\x00\x1c\x85 é", "en"),
    ]
    return [(d, t, lang, "hot", None if t is None else len(t), "s", 7, "d", 1, "w", "p", "l", "n") for d, t, lang in texts]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3, F.col("source"), F.col("text"))


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df, key="doc_id"):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
