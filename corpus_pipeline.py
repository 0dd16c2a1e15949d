"""A corpus from raw documents to packed training sequences, stage by stage.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; what it returns is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the columns of
``documents`` for the rows they keep.  Every stage takes null texts, empty tables and
extra columns; what happens to each is said with the operator it calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import stored, table
from marlstone.llm.exact_dedup import content_sort_dedup
from marlstone.llm.near_dedup import near_duplicates
from marlstone.llm.packing import pack_best_fit
from marlstone.llm.quality_rules import quality_rules
from marlstone.llm.toxicity import learnable, toxicity, train_toxicity

# Production values of the near-duplicate stage: five words, similarity 0.8.
SHINGLE_WORDS, SIMILARITY = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the toxicity model does not reject."""
    model = train_toxicity(docs, table(spark, sf_dir, "labels"), learnable())
    return toxicity(docs, model).where("predicted = 0").select("row.*")


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the quality rules."""
    return quality_rules(docs).where("kept").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return content_sort_dedup(docs).where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest identifier.

    Rows without identifier stay.
    """
    verdict = near_duplicates(docs, width=SHINGLE_WORDS, similarity=SIMILARITY)
    dropped = stored(verdict.where(~F.col("kept")).select("doc_id").distinct(), "dropped")
    # Spark broadcasts the written ids below its limit and sort-merges above.
    return docs.join(dropped, "doc_id", "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their place in the training sequences."""
    import public_tokenizers

    return pack_best_fit(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_good_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

# The first stage is a trained model; SQL cannot express it (see tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
