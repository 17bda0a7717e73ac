"""Small tables with the awkward cases that every operator has to take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("row", "fp", "score", "size", "kept", "line", "drop", "_row", "_id", "node", "tokens", "id", "lines", "key")


def awkward(spark, extra=True):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns named like internal ones."""
    rnd = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "Lambda", "Été"]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared = "This line is long enough to be counted, and many documents have it."
    long = text(20_000)
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, " \t\n \x0b\x0c\r", "en", "a", 6), (None, text(60), "en", None, 3),
            (4, long, "en", "b", len(long)), (5, "one", "de", "b", 3), (5, "one", "de", "b", 3), (6, "one two", "de", "c", 7)]
    rows += [(k, text(40) + "\n" + shared + "\n" + text(30), "en", "hot", 5) for k in range(10, 40)]
    base = text(200)
    rows += [(k, base + (" x" if k % 2 else ""), "fr", "hot", 9) for k in range(50, 60)]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit(c) for c in CLASHING})
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
