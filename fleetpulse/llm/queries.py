"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.alignment import alignment_rows
from fleetpulse.llm.common import table
from fleetpulse.llm.decontamination import contamination_rows
from fleetpulse.llm.fill_middle import fill_middle_rows
from fleetpulse.llm.language import language_rows
from fleetpulse.llm.line_dedup import line_rows
from fleetpulse.llm.maxent import language_model_rows
from fleetpulse.llm.near_duplicates import near_duplicates
from fleetpulse.llm.oracle import ORACLE_SQL
from fleetpulse.llm.packing import pack
from fleetpulse.llm.quality import quality_rows
from fleetpulse.llm.quotes import quote_rows
from fleetpulse.llm.search import nearest
from fleetpulse.llm.sharding import shard_rows
from fleetpulse.llm.toxicity import toxicity_rows


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Where the installed vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    vectors = table(spark, folder, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op2_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Quoted passages of all conversations linked to their originals."""
    return quote_rows(table(spark, folder, "conversations"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated runs of lines removed from all documents."""
    return line_rows(table(spark, folder, "documents"), whole=True)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity_rows(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates among all documents, by shingles of four words."""
    return near_duplicates(table(spark, folder, "documents"), size=4)


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark phrases in every document."""
    return contamination_rows(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    return quality_rows(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    return language_rows(table(spark, folder, "documents"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return pack(table(spark, folder, "documents"), tokenizer_file())


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes, equal texts together."""
    placed = shard_rows(table(spark, folder, "documents"), shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in fill-in-the-middle form."""
    return fill_middle_rows(table(spark, folder, "documents"))


def op12_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Probability of every document under a maximum-entropy model of the documents."""
    return language_model_rows(table(spark, folder, "documents"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level tokens and pieces of every document, aligned."""
    documents = table(spark, folder, "documents")
    return alignment_rows(documents, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


QUERIES = {
    "op1_nearest": op1_nearest,
    "op2_quotes": op2_quotes,
    "op3_line_dedup": op3_line_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_decontamination": op6_decontamination,
    "op7_quality": op7_quality,
    "op8_language": op8_language,
    "op9_packing": op9_packing,
    "op10_sharding": op10_sharding,
    "op11_fill_middle": op11_fill_middle,
    "op12_language_model": op12_language_model,
    "op13_alignment": op13_alignment,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
