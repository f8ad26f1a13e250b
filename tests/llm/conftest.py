"""Small awkward tables shared by the tests of this folder."""

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, d string, v string, size long, h int"
PASSAGE = " ".join(f"shared{i}" for i in range(60))
LINES = "\n".join(f"line {i} of a passage that repeats" for i in range(4))


def awkward_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows, clashing extra columns."""
    texts = [
        (1, "alpha beta gamma delta epsilon zeta " + PASSAGE, "s1"), (2, "eta theta iota kappa " + PASSAGE + " tail of the second one", "s1"),
        (3, None, "s2"), (4, "", "s2"), (None, "one two three four five six seven", None), (5, "one two three four five six seven", "s3"),
        (5, "one two three four five six seven", "s3"), (5, "another text with the same id " * 3, None), (6, "x", "s1"), (7, "Ünï cödé ß " * 40, "s1"),
        (8, LINES + "\nmine", "s1"), (9, "before\n" + LINES + "\nafter", "s1"), (10, " ".join(f"w{i % 977}q{i}" for i in range(20000)), "s4"),
        (11, "\t\n \x0b\x0c\r", "s4"), (12, "...!!!", None), (13, "aaaa" * 200, "s4"),
    ]
    return [(d, t, None, s, None if t is None else len(t), "clash", "clash", 7, None) for d, t, s in texts]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOC_SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    return sorted((r.asDict() for r in rows), key=lambda r: r["doc_id"])
