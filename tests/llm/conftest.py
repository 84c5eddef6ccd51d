import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} other{i % 31}." for i in range(40_000))
GOOD = " ".join(f"Sentence {i} tells of river number {i * i}." for i in range(30))
ROWS = [
    (1, GOOD), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, GOOD.upper()), (6, GOOD.upper()),
    (None, GOOD), (None, None), (7, "one"), (8, "two words"), (9, "ÀÉ été <|endoftext|> 日本 🙂"),
    (10, GOOD + " End."), (11, "x" * 5000), (12, "!!! ... ???"),
]
# Names that operators use inside for their own columns.
CLASHING = ("name", "word", "row", "score", "kept", "part", "n", "c", "fp", "key", "far", "length",
            "pos", "node", "root", "y", "half", "features", "lang", "source", "class", "digest")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, repeats and clashing extra columns."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    return docs.select("*", *(F.lit(None).cast("string").alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, name string")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (6, 0, 1), (6, 0, 1), (5, None, None), (None, 1, 1), (99, 1, 0), (10, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
