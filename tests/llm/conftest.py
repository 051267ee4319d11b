import random

import pytest

#: columns that operators use inside; a table may have them as well
CLASHING = ("n", "x", "key", "row", "block", "entry", "hash", "size", "marks", "score", "kept", "item", "bin", "id", "v")


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table: (doc_id, text) pairs, with clashing extra columns on demand."""

    def make(rows, extra=False):
        given = [(i, t, "en", "s", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
        for name in CLASHING if extra else ():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("?"))
        return df

    return make


@pytest.fixture(scope="session")
def prose():
    """Seeded nonsense of so many words."""

    def make(n, seed, vocabulary=4000):
        r = random.Random(seed)
        return " ".join("".join(r.choices("abcdefghiou", k=2 + v % 7)) for v in (r.randrange(vocabulary) for _ in range(n)))

    return make
