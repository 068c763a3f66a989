import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    return SF


@pytest.fixture(scope="session")
def documents(spark, sf):
    """The small documents table, in rows and as a frame."""
    df = spark.read.parquet(f"{sf}/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


BASE = " ".join(f"w{i}" for i in range(60))
EDGES = [
    (1, BASE),
    (2, BASE),  # a copy
    (2, BASE),  # the same row again
    (3, BASE.replace("w59", "changed")),  # a near copy
    (4, None),
    (5, ""),
    (6, " \n\t \x0b "),
    (7, "one two"),
    (8, "ONE two"),
    (9, BASE.upper()),
    (10, "x" * 20_000 + " " + "y z " * 3_000 + BASE),  # very long, periodic
    (11, "café 中文 \x1c sep arated <|endoftext|> a  b   c \n d"),
    (12, "same same same same same same same same same same same same same same same same same same same same same same same"),
    (None, BASE),
    (None, None),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and long texts, ties, repeated rows; extra columns with names the operators use themselves."""
    schema = "doc_id long, text string, uid string, places string, digest string, salt int, row string, host string, source string, n_chars long"
    rows = [(i, t, "u", "p", "d", 1, "r", "h", None if k % 3 else "s", len(t or "")) for k, (i, t) in enumerate(EDGES)]
    return spark.createDataFrame(rows, schema), EDGES


@pytest.fixture(scope="session")
def empty(spark, edges):
    return edges[0].limit(0)
