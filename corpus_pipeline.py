"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``. Stages are written
and read again between one another, so a later stage neither recomputes an earlier one nor depends on the executors
that ran it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medcohort.llm.common import materialise, read_table
from medcohort.llm.decontamination import decontaminate
from medcohort.llm.line_dedup import dedup_lines
from medcohort.llm.ngram_join import drop_near_copies
from medcohort.llm.packing import pack_documents
from medcohort.llm.toxicity import drop_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier, fitted on the labelled documents of ``sf_dir``, scores as toxic."""
    return drop_toxic(docs, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated lines; a document of repeated lines only stays with an empty text."""
    left = dedup_lines(docs).select(*docs.columns)
    return left.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of least id of each group of copies and near copies."""
    return drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents contaminated by benchmark items."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: No SQL: the classifier, the tokenizer and the packing cannot be expressed.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
