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


def invented(seed: int, words: int, syllables=("th", "er", "on", "an", "re", "he", "ti", "ou")) -> str:
    rng = random.Random(seed)
    return " ".join(
        "".join(rng.choices(syllables, k=rng.randint(1, 4))) + rng.choice(["", "", "", ".", ","])
        for _ in range(words)
    )


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, ties, repeated rows, and long texts."""
    base = invented(1, 120)
    rows = [
        (1, base, "en", "a", 10),
        (2, base, "en", "a", 10),
        (2, base, "en", "a", 10),
        (3, base.replace("er", "ER", 3), "en", "b", None),
        (4, None, "en", None, None),
        (5, "", None, "a", 0),
        (6, " \n\t\x0b\x0c\r ", "fr", "b", 1),
        (None, "one", "fr", None, None),
        (None, base + " " + invented(2, 60), None, "b", None),
        (7, "é—漢字 😀 ß́ don't I'LL x²½ İıſ   A B <|endoftext|> x", "de", "c", 5),
        (8, invented(3, 30) + "\n" + invented(3, 30) + "\n" + invented(4, 30), "de", "c", 9),
        (9, "spam " * 60, "de", "c", 9),
        (10, invented(5, 20_000), "fr", "c", 99),
        (11, "the end\r\n\r\nof it", "fr", "a", 9),
        (12, invented(1, 119) + " changed", "en", "a", 9),
        (-5, invented(6, 13), "en", "a", 9),
    ]
    return rows + [(100 + i, invented(50 + i, 40), "en" if i % 2 else "fr", "d", i) for i in range(20)]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture
def clashing(awkward):
    """Further columns called like results."""
    from pyspark.sql import functions as F

    names = (
        "N_WORDS score kept piece length offset fingerprint component_id spans held_out "
        "base_failed n_items group_print lang_pred predicted n_bytes"
    )
    return awkward.withColumns({name: F.lit(name) for name in names.split()})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def as_multiset(rows) -> list:
    return sorted((tuple(row) for row in rows), key=repr)
