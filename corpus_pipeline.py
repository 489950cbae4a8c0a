"""Corpus preparation: toxic documents out, near copies out, benchmark text out, secrets masked, the rest packed.

Every stage but the last returns the columns it was given, in their order, and
all of a document's other columns unchanged, extra ones of any name included.
Null and empty texts are kept by all stages (they score below any limit, are
near to nothing, hold neither benchmark words nor secrets) and pack as their end
id. Rows without id are kept; rows of one id count as copies of one document in
the near-duplicate stage and as separate ones elsewhere. Texts of any length are
taken whole. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import credentials, decontaminate, packing, superminhash, toxicity
from ledgerline.llm.common import table, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a model fitted on the labelled ones among them."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group that five-word shingles link at 0.8."""
    return superminhash.deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents cut clear of benchmark windows; those hit in more than half of their words go."""
    return decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets of few owners masked."""
    return credentials.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

# Compressed lengths, 64-bit hashes of word runs and token ids are out of SQL's reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before kept; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
