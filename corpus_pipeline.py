"""Corpus pipeline: quality rules, near duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  ``run`` writes every stage's result as
Parquet in the shared folder and reads it back as the next one's input, so a lost
executor costs at most one stage's open tasks.

Defined results: every stage takes null, blank and very long texts, ties and
repeated rows, empty tables and further columns as its operator states them.
Rejected documents, all but one document of a group of near duplicates, and
masked spans are gone from there on; mixing repeats a document once per epoch
and cuts one document a source at its budget; packing returns one row a piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelle.llm import mixing, ngram_join, packing, pii, quality
from parcelle.llm.common import spill


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents stays."""
    return ngram_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are masked by their kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeat or end as their target weights say."""
    return mixing.mix_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their sequence and place."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: SQL has no tokenizer and no trained tagger; the tests hold ``run`` against a
#: brute-force version stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = spill(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
