"""Corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of
documents (the last returns packed pieces). ``run`` writes every stage's result to the
shared folder and gives the next stage the table read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens.llm.common import read_table
from churnlens.llm.exact_dedup import drop_exact_duplicates
from churnlens.llm.mixing import mixed_documents
from churnlens.llm.packing import pack_documents
from churnlens.llm.partenum import drop_near_duplicates
from churnlens.llm.quality import fit_quality, keep_quality
from churnlens.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels outside its held-out fold, accepts."""
    return keep_quality(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of the smallest id."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document of the smallest id."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix, packed into sequences."""
    return pack_documents(docs)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

#: Training, similarity components and tokenisation have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
