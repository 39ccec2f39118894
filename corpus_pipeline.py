"""From raw documents to packed sequences: toxicity, near duplicates, benchmark passages, personal data, packing.

Each stage works on all rows that its predecessor kept, and is written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelspark.llm.common import table, written
from reelspark.llm.decontamination import drop_contaminated
from reelspark.llm.jaccard import one_of_each
from reelspark.llm.packing import pack_documents
from reelspark.llm.personal import mask_personal
from reelspark.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on those of `docs` that have labels, does not reject."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return mask_personal(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity), ("jaccard", jaccard), ("decontamination", decontamination), ("personal", personal),
    ("packing", packing),
]

#: The classifier and the field have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
