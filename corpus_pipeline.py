"""Corpus pipeline: from the documents table to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns the rows for the next;
all but the last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored, table, workers_find_package
from fleetpulse.llm.decontamination import remove_phrases
from fleetpulse.llm.line_dedup import dedup_lines
from fleetpulse.llm.near_duplicates import near_duplicates
from fleetpulse.llm.packing import pack
from fleetpulse.llm.quality import score_quality, train
from fleetpulse.llm.queries import tokenizer_file

LEAST_QUALITY = 0.7

# A trained model and a packing have no SQL form.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).where(F.col("quality_score") >= LEAST_QUALITY).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, runs of lines that another one has cut out."""
    workers_find_package(spark)
    return dedup_lines(docs, whole=True).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id."""
    workers_find_package(spark)
    dropped = near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, passages of the benchmark cut out."""
    return remove_phrases(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences of 4096."""
    workers_find_package(spark)
    return pack(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
