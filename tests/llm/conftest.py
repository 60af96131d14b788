"""Rows that every operator must take: nulls, empty and very long texts, ties, repeated rows, clashing names."""

import random

import pytest

WORDS = "the of and thing ouer lytion haner stea this with éon über niño".split()


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "ing", "er", "tion"]) + str(rng.randrange(40) or "")
                    for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): in no order, with repeated ids, a null id, null and empty texts."""
    long = prose(1, 30_000)
    return [(7, prose(7, 120)), (3, None), (9, ""), (1, "one"), (1, "one"), (4, prose(7, 120)), (12, long),
            (None, prose(5, 40)), (11, "  \n\t "), (10, "Ünï <|endoftext|> don't, stop."), (8, prose(8, 60) + " " + prose(7, 90)),
            (20, prose(20, 300)), (2**60, prose(21, 12))]


@pytest.fixture(scope="session")
def odd_documents(spark, odd_rows):
    """The rows with columns whose names the operators use inside."""
    rows = [(t, i, "x", 1, "y", 2.0, None) for i, t in odd_rows]
    return spark.createDataFrame(rows, "text string, doc_id long, lang string, bucket int, head string, component double, "
                                       "signature string").repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
