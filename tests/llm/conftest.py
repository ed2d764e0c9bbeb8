import pytest
from pyspark.sql import Row

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that some operator uses inside for itself.
CLASHING = ["id", "fp", "key", "run", "place", "row", "component", "bucket", "epoch", "gone_id", "text_hash", "own_sha256", "mixture_row", "TOKENS"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    prose = "the quick brown fox jumps over the lazy dog and runs away from the big house at night"
    rows = [
        (1, prose, "en", "a"),
        (2, prose + " \n", "en", "a"),
        (3, prose.replace("quick", "slow"), "en", None),
        (4, None, "en", "b"),
        (5, "", None, "b"),
        (6, " \t\n", "de", "b"),
        (7, "x", "de", None),
        (8, "word " * 30_000, "en", "a"),
        (9, "ä" * 50_000, "de", "c"),
        (None, prose, "en", "a"),
        (None, None, None, None),
        (10, prose, None, "c"),
        (10, prose, None, "c"),
        (11, "same id, one text", "en", "d"),
        (11, "same id, other text", "en", "d"),
        (12, prose.upper(), "en", "c"),
    ]
    full = [Row(doc_id=i, text=t, lang=lang, source=s, n_chars=None) for i, t, lang, s in rows]
    docs = spark.createDataFrame(full, DOCUMENTS).coalesce(2)
    for name in CLASHING:
        docs = docs.withColumn(name, docs["lang"])
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
