"""Hostile rows that every operator on documents must take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def documents(spark, more=()):
    base = words(60, 1)
    shared = words(20, 2)
    rows = [
        (1, base),
        (2, base),  # exact copy
        (3, base.upper()),
        (4, base + " tail"),
        (5, words(30, 3) + " " + shared + " " + words(9, 4)),
        (6, shared + "\n" + words(5, 5)),
        (7, ""),
        (8, None),
        (9, "  \t\n "),
        (10, "a " * 40),
        (11, "a " * 55 + "b " * 30),
        (12, "a " * 18 + "b " * 15),
        (13, "één über naïve 日本語 text  with   spaces"),
        (14, words(30_000, 6)),  # very long
        (15, "x" * 5000),
        (5, words(25, 7)),  # a doc_id twice
        (7, ""),  # a repeated row
        (None, base),  # no doc_id
        (16, words(12, 8)),
        (17, words(13, 9)),
        (18, words(13, 9)),
        (19, "one two"),
        (20, "x y " * 30),
        (21, "z x y " + "x y " * 12),
        *more,
    ]
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t else 0) for i, t in rows], DOCS)


def extra_columns(df):
    """Columns whose names operators use inside."""
    from pyspark.sql import functions as F

    for name in ("fp", "key", "a", "b", "n", "name", "digest", "words", "pos", "label", "start", "component", "node", "ids", "n_tokens", "page", "score"):
        df = df.withColumn(name, F.lit("clash"))
    return df
