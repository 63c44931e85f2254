"""Registered queries of this subpackage: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.session import scratch_path

from .common import read_table
from .exact_dedup import exact_duplicates
from .hard_negatives import mine_hard_negatives, relabelled
from .license_scan import scan_licenses
from .line_dedup import drop_boilerplate
from .mixing import mix_sources
from .packing import pack_documents
from .partenum import similar_components
from .quality import fit_quality, score_quality
from .streaming_bpe import bpe_round_trip
from .suffix_dedup import remove_repeats
from .topk import topk_inner_product
from .warc import archive_round_trip
from .whitening import whiten


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree of three depths: source / thousands / hundreds of the id / id; ids divisible by ten
    lie in the folder of the thousands, those divisible by fifty in that of the source."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.expr("if(doc_id % 50 != 0, cast(doc_id div 1000 AS string), null)"),
                       F.expr("if(doc_id % 10 != 0, cast(doc_id div 100 % 10 AS string), null)"), F.col("doc_id").cast("string"))
    return scan_licenses(read_table(spark, sf_dir, "documents").withColumn("path", path))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of their source."""
    out = drop_boilerplate(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_dropped").cast("long").alias("n_dropped"),
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def topk_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_inner_product(read_table(spark, sf_dir, "embeddings"))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(read_table(spark, sf_dir, "documents"))


def mix_systematic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def bpe_streaming(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe_round_trip(read_table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
                      digest(F.col("decoded")).alias("decoded_sha256"))


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_hard_negatives(relabelled(read_table(spark, sf_dir, "embeddings")))


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_exact_dedup": exact_dedup,
    "op2_quality_classifier": quality_classifier,
    "op3_warc_salvage": warc_salvage,
    "op4_license_scan": license_scan,
    "op5_suffix_dedup": suffix_dedup,
    "op6_line_dedup": line_dedup,
    "op7_topk_threshold": topk_threshold,
    "op8_ngram_jaccard_join": ngram_jaccard_join,
    "op9_mix_systematic": mix_systematic,
    "op10_pack_best_fit": pack_best_fit,
    "op11_bpe_streaming": bpe_streaming,
    "op12_hard_negatives": hard_negatives,
    "op13_whitening": whitened,
}
