from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

# Extra columns whose names the operators use themselves, or that only look like them.
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        *[T.StructField(name, T.StringType()) for name in ("id", "key", "score", "blob", "found", "fp", "fingerprint", "h", "part", "ids", "target", "node")],
    ]
)
TOKENIZERS = "/opt/tokenizers"


def sentences(count: int, seed: int = 1) -> list[str]:
    draw = random.Random(seed)
    syllables = "the an re ing tion ou er st nd ha wh ly é ñ ß 日".split()
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randint(1, 3)))
    return [" ".join(word() for _ in range(draw.randint(3, 60))) + draw.choice([".", "", "!\n", "  "]) for _ in range(count)]


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """(id, text): plain ones, copies, repeated rows, nulls in both, empty, white space only, one very long."""
    texts = sentences(40)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[3]) for i in range(25)]
    rows += [(200, ""), (201, None), (202, "   \n\t"), (203, "a"), (204, "x" * 5_000), (205, " ".join(texts) * 4), (206, "one two")]
    rows += [(5, texts[5]), (5, texts[5]), (None, texts[7]), (None, None), (None, "no id here"), (7, "another text under a known id")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame([(i, t, *["z"] * (len(DOCS) - 2)) for i, t in odd_rows], DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def pairs(frame, *columns) -> list[tuple]:
    """The rows as sorted tuples, nulls first."""
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=lambda row: tuple((x is not None, x) for x in row))


def ordered(rows) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((x is not None, x) for x in row))
