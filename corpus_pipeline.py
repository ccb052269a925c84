"""Training-corpus pipeline: quality rules, exact dedup, near dedup, surrogates, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
works on all its predecessor kept and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civicflow.llm.common import ship, stored, table
from civicflow.llm.exact import drop_copies
from civicflow.llm.neardup import drop_near_copies
from civicflow.llm.pack import pack
from civicflow.llm.pii import replace_all
from civicflow.llm.quality import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that fail the base rules or the trees go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of equal normalised texts the longest original stays (then the smallest doc_id)."""
    ship(spark)
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group over five-word shingles at similarity 0.8 stays."""
    ship(spark)
    return drop_near_copies(docs, size=5)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: personal data and secrets become surrogates in ``text``."""
    ship(spark)
    return replace_all(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the documents' pieces in sequences of at most 1024 tokens."""
    ship(spark)
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("surrogates", surrogates),
    ("packing", packing),
]

#: Boosted trees, keyed surrogates and packing have no SQL form; tests compare each stage with its operator, and the operators with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents at ``sf_dir``; returns the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
