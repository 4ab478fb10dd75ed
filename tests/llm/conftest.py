import random

import pytest
from pyspark.sql import functions as F

WORDS = "the and of river stone cloud winter market paper engine yellow quiet simple garden window music letter number coffee bridge".split()


def prose(draw, n):
    return " ".join(draw.choice(WORDS) + (draw.choice([".", ",", ".\n"]) if draw.random() < 0.15 else "") for _ in range(n))


@pytest.fixture(scope="session")
def corpus_rows():
    """Null and empty texts, a null id, copies, near copies, a repeated row, an id with two texts, a long text."""
    draw = random.Random(5)
    rows = [(i, prose(draw, draw.randint(1, 120))) for i in range(60)]
    long = prose(draw, 30_000)
    rows += [(60, None), (61, ""), (62, ""), (None, "a text without an id " * 8), (None, None), (63, long), (64, long + " more"), (65, rows[3][1]),
             (66, rows[3][1]), (67, rows[9][1] + " added"), (68, "ÉÀ ß İ 中文 😀 \x00 \x0b " * 9), (69, "\n\n \t"), (70, "aaaa" * 200), (71, "x" * 5000)]
    rows += [(5, rows[5][1]), (7, "another text under an id that is there already, long enough to be looked at by every operator of these")]
    return rows


@pytest.fixture(scope="session")
def corpus(spark, corpus_rows):
    """The rows with extra columns whose names operators may use themselves."""
    docs = spark.createDataFrame(corpus_rows, "doc_id long, text string").repartition(3)
    return docs.withColumns({c: F.lit("extra") for c in ("score", "hash", "n", "fingerprint", "doc", "kept", "group_size", "line", "leaf", "spans", "label", "keep_id")})


@pytest.fixture(scope="session")
def empty(corpus):
    return corpus.limit(0)
