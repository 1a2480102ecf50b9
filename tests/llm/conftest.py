import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, cell int, order string, _key long"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(20_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, and columns named like the operators' own."""
    plain = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, plain, "en", "a"), (1, plain, "en", "a"), (2, plain.upper(), "en", "b"), (3, plain.replace(" ", "\t\n "), None, None),
        (4, None, None, None), (5, "", "en", "a"), (6, " \t\n", "de", "b"), (None, plain, "en", "a"), (None, None, None, None),
        (7, LONG, "en", "a"), (8, LONG + " end", "en", "a"), (9, "short", "fr", "c"), (9, "short", "fr", "c"), (10, "ein Wört ü", "de", ""),
        (11, "<|im_start|>\\ tab\there", "es", "b"), (12, "12 34 %% ...", "en", "c"),
    ]
    made = spark.createDataFrame([(*r, None, "x", 7, "y", 9) for r in rows], SCHEMA)
    return made.withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)
