"""Small tables for the corpus operators."""

import random

DOCS = "doc_id long, text string, h1 long, row string, score double, node long, fingerprint string, t1 long"


def odd_docs(spark, texts=()):
    """Null, empty, long, repeated and tied rows, with extra columns whose names operators use themselves."""
    rows = [(1, None), (2, ""), (None, "a text without an id"), (None, None), (3, "same text here"), (4, "same text here"),
            (5, "twice the same row"), (5, "twice the same row"), (6, "one id and this text"), (6, "one id and another text"),
            (7, " \n\t\n  \n"), (8, "word " * 40_000), (9, "x" * 50_000), (10, "späte Größe\nnaïve café — 東京 🙂 end"),
            *enumerate(texts, 100)]
    return spark.createDataFrame([(i, t, 1, "r", 0.5, 2, "f", 3) for i, t in rows], DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def prose(seed, n_words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n_words))


def edited(text, seed, edits):
    rng = random.Random(seed)
    words = text.split(" ")
    for i in rng.sample(range(len(words)), edits):
        words[i] = f"new{rng.randrange(10**6)}"
    return " ".join(words)
