"""Small document tables, with the awkward rows that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """``(doc_id, text)`` rows as documents, over a few partitions."""
    made = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(made, DOCS).repartition(3)


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, repeated ids, odd characters, a long text."""
    rnd = random.Random(3)
    words = ["alpha", "Beta", "gamma,", "delta.", "épée", "日本語", "x" * 300, "3", "km"]
    long = " ".join(rnd.choice(words) for _ in range(4000))
    return [(1, "One two three four five six"), (2, "one TWO three four five six"), (2, "one TWO three four five six"), (3, None), (4, ""), (5, " \t\n "), (None, "one two three four five six"), (None, None), (6, long), (7, long), (7, "other text under one id"), (8, "▁ literal \x00\x1c 　 mark 𝒳"), (9, "w")]


def with_extra_columns(df):
    """Columns whose names operators use inside."""
    for name in ("digest", "fp", "score", "shard", "grp", "key", "unit", "part", "block", "ids", "y", "n", "hash", "number", "_key", "root"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
