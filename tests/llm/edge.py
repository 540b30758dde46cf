"""Rows that every operator has to take: nulls, empty and very long texts, copies, odd columns."""

import random

from pyspark.sql import functions as F

#: Names that operators might use inside.
CLASHES = (
    "row id order key size length rank bucket score features fingerprint words source_size "
    "sequence_id n_lines digest payload first root node a b n text_a docs drops"
).split()

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def texts():
    long = prose(1, 30_000, 5000)
    return [
        (1, prose(2, 120), "en", "b"),
        (2, prose(2, 120), "en", "a"),
        (2, prose(2, 120), "en", "a"),
        (3, None, "en", "a"),
        (4, "", None, None),
        (5, " \t\n ", "de", "a"),
        (6, long, "de", "b"),
        (7, long + " tail", "de", None),
        (None, "one", None, "a"),
        (None, None, None, None),
        (8, "Éa ß İ   \x85 x\x00y <|endoftext|>", "fr", "é"),
        (9, "A\nb \nB\n\n a", "fr", "b"),
        (10, prose(3, 60) + "\n" + prose(4, 60), "en", "b"),
        (11, "12 34 -- !!", "en", "b"),
        (-5, prose(5, 3), "en", "b"),
    ]


def documents(spark, rows=None, partitions=3):
    rows = texts() if rows is None else rows
    frame = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    return frame.repartition(partitions)


def with_clashes(frame):
    named = [n for n in CLASHES if n not in frame.columns]
    return frame.withColumns({n: F.lit("x") for n in named}).withColumn("odd.name `x`", F.lit(1))
