import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def make(rows, extra=None):
        """Rows of (doc_id, text[, lang[, source]]); ``extra`` are names of further columns."""
        full = [(*r, *("en", "src0")[len(r) - 2:], None) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.select("*", *[F.lit(1).alias(c) for c in extra or ()])
    return make


@pytest.fixture(scope="session")
def prose():
    """Invented but reproducible text: ``prose(seed, words)``."""
    import random

    def make(seed, n):
        draw = random.Random(seed)
        return " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 8))) for _ in range(n))
    return make
