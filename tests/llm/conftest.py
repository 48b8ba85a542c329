import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def frame(spark, rows, parts=3):
    """(id, text[, source]) as a documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts) if full else spark.createDataFrame([], DOCS)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ".", ",", ".\n"]) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, short and long texts; copies; near copies; equal ids."""
    rng = random.Random(3)
    base, long = prose(rng, 120), prose(rng, 6000, 3000)
    near = base.split(" ")
    near[60] = "changed"
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "ONE"),
            (9, "two words"), (10, long), (11, long + " tail of its own"), (12, "é" * 130), (13, "é" * 130 + "ü"),
            (14, "a b c " * 80), (15, "ab " * 400), (16, base + "\n" + prose(rng, 100)), (None, prose(rng, 80)),
            (17, prose(rng, 70)), (17, prose(rng, 70)), (18, prose(rng, 90)), (18, prose(rng, 90)), (19, "x" * 500)]
    rows += [rows[-2]]
    for k in range(20, 50):
        words = base.split(" ")
        words[rng.randrange(len(words))] = f"n{k}"
        rows.append((k, " ".join(words)))
    rows += [(k, prose(rng, rng.randrange(1, 200))) for k in range(50, 80)]
    return rows
