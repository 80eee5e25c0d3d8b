"""The corpus pipeline: documents in, packed pieces out.

Stages hand on all columns of their input, whatever their names, until the last one. An empty table
gives an empty table. Null ids and repeated rows pass like others, as each stage says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sigloom.llm.decontam import decontaminate
from sigloom.llm.exact_dedup import exact_dedup
from sigloom.llm.jaccard_join import near_dedup
from sigloom.llm.language_id import fit_languages, keep_recognised
from sigloom.llm.packing import pack_documents
from sigloom.session import released, settled


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are null or empty, hold no letter or fit two languages alike go. Repeated rows stay or go together."""
    return keep_recognised(docs, fit_languages(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, null and empty ones among them, the document with the largest id stays, once; null ids lose."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 the one with the smallest id stays; texts without words and null ids stay."""
    return near_dedup(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces in sequences of 1024 tokens; a null or empty text is its end id alone, repeated rows are packed each."""
    return pack_documents(docs)


STAGES = [("language ID", language), ("exact dedup", exact), ("n-gram Jaccard join", near), ("benchmark decontamination", clean), ("packing", pack)]

#: Compression, alignment and packing have no SQL; tests run the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = settled(docs, name.replace(" ", "-"))
            released(before)
    return docs
