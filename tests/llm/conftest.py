"""Fixtures: documents with every awkward case, and the smallest of the given tables."""

import os
import random

import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id string, n int, h string, size string, key string, component string, block string, grp string, toxic string")
CLASH = ("x",) + (7,) + ("x",) * 7


def _prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(["alpha", "beta", "gämma", "delta", "Epsilon", "zeta,", "eta.", "theta", "Iota", "kappa"]) + str(r.randrange(40))
                    for _ in range(n))


ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t\r\x0b\x0c ", "en", None), (4, "word", "en", None), (5, "two words", "en", "b"),
    (6, _prose(60_000, 1), "de", "a"), (7, _prose(300, 2), "de", "a"), (8, _prose(300, 2), "de", "b"), (9, _prose(300, 2) + " more", None, "c"),
    (10, _prose(80, 3), "en", "a"), (10, _prose(80, 3), "en", "a"), (None, "nobody knows this document by its number at all", "en", "a"),
    (11, "same line here\n" * 30, "en", "c"), (12, "x" * 50_000, "en", "c"), (13, "the end \U0001F600 of it " * 20, "en", "a"),
    (14, None, "en", None), (15, "", None, None), (16, "a b c d e f g h i j k l m n o p", "en", "é"), (-3, "two words", "en", "b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), *CLASH) for i, t, lang, s in ODD], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    return SF


@pytest.fixture(scope="session")
def given(sf):
    """doc_id -> text of the smallest documents table."""
    t = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"])
    return dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
