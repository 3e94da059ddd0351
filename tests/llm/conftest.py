import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def prose(seed: int, words: int = 40) -> str:
    rnd = random.Random(seed)
    syllables = "an the ti on re er in of st nd ou ha lé üß ño".split()
    out = []
    for i in range(words):
        word = "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
        out.append(word + ("." if i % 9 == 8 else "") + ("\n" if i % 20 == 19 else " "))
    return "".join(out)


def awkward() -> list[tuple]:
    """Nulls in any column, empty and very long texts, ties, repeated rows, copies."""
    texts = [
        (1, prose(1)), (2, prose(2)), (3, prose(1)), (4, ""), (5, None), (6, "a"), (7, " \n\t "), (7, " \n\t "),
        (8, prose(8, 6000)), (9, "x" * 40000), (10, " " * 3000 + "end"), (None, prose(11)), (None, None), (12, prose(12)),
        (12, prose(13)), (13, "日本語 текст ünï 🙂 1²³ it's"), (14, prose(2) + "more words here at the end."), (-5, prose(15)),
        (15, prose(1)), (15, prose(1)), (9007199254740993, prose(16)),
    ]
    return [(i, t, None if k % 3 else "en", None if k % 4 else "src0", None if t is None or k % 5 == 0 else len(t)) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """Further columns that are named like inner or result columns of the operators."""
    from pyspark.sql import functions as F

    names = "size shard slot score ids fp component_id n_tokens start length offset spans base fingerprint near_next _text _part _row _range row id".split()
    return docs.select("*", *(F.lit(f"own {n}").alias(n) for n in names))
