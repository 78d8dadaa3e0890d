"""Small documents with all that may go wrong in them, and word lists to make texts from."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, size int, target string, digest string"


def docs(spark, rows):
    """Rows of (doc_id, text, lang, source), with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, g, s, len(t or ""), "x", 7, "y", "z") for i, t, g, s in rows], DOCS)


def words(rng, n, stem="w", most=400):
    return " ".join(f"{stem}{rng.randrange(most)}" for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and blank texts, repeated rows, ties and a very long text."""
    long = words(random.Random(5), 30_000)
    return [
        (1, "Hello  world again", "en", "a"), (2, "hello world again", None, "a"), (3, "Hello\tworld\nagain", "de", None), (4, None, "en", "b"), (5, "", None, None),
        (6, " \n\t ", "en", "b"), (None, "Hello world again", "en", "a"), (None, None, None, None), (7, "Hello world again", "en", "a"), (7, "Hello world again", "en", "a"), (8, long, "en", "a"), (9, long + " more", "en", "c"), (10, "ä", "fr", "c"),
    ]
