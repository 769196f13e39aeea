import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def prose(seed: int, words: int, stock: int = 400) -> str:
    rng = random.Random(seed)
    letters = random.Random(99)
    pool = ["".join(letters.choice("abcdefghiklmnoprstuvw") for _ in range(letters.randint(2, 8))) for _ in range(stock)]
    return " ".join(rng.choice(pool) for _ in range(words))


@pytest.fixture(scope="session")
def documents(spark):
    """Copies, near copies, a shared passage, odd texts, nulls, repeated rows, and columns with the names of results."""
    base, passage = prose(1, 120), prose(2, 60)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base), (2, base), (3, " ".join(near)), (4, prose(3, 80) + " " + passage), (5, passage + "\n" + prose(4, 90)), (6, prose(5, 100)),
        (7, ""), (8, None), (9, "   \n\t "), (10, "one two"), (11, "!!! ??? 123"), (11, "!!! ??? 123"), (None, prose(6, 50)), (None, None),
        (12, prose(7, 30_000, 5000)), (13, "äöü " * 40), (14, prose(5, 100).upper()),
    ]
    full = [(i, t, None if k % 5 == 0 else ("en", "de")[k % 2], None if k % 4 == 3 else f"s{k % 3}", len(t) if t else None) for k, (i, t) in enumerate(rows)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(full, DOCUMENTS)
    for clash in ("id", "content", "size", "target", "window", "start", "score", "n_words", "key", "root", "rank", "_text"):
        df = df.withColumn(clash, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
