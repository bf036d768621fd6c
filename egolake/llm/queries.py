"""Queries and SQL of the operators of this subpackage, as the driver's contract names them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jpeg, mixing, near_dedup, pieces, quality, secret_scan, sharding, substring_dedup, toxicity, warc

#: The model file of op10, by its name in the folder of public tokenizers.
PIECE_MODEL = "piece_bpe_32k.model"
#: Bytes of a shard of op6, small enough that buckets split at every scale.
SHARD_BYTES = 256 << 10


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at 85 % of their 3-word shingles."""
    return near_dedup.near_duplicates(_docs(spark, sf_dir), shingle=3, num=85, den=100)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, and whether its share of content lines retains it."""
    return quality.quality(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity of every text."""
    docs = _docs(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("text")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the passages of 50 words that an earlier document has."""
    return substring_dedup.without_repeats(_docs(spark, sf_dir))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text."""
    return secret_scan.digest(_docs(spark, sf_dir))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mixture of sources."""
    docs = _docs(spark, sf_dir).select("doc_id", "source")
    return mixing.scheduled(docs, most=None)


def op5_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text through a progressive JPEG and back, with a feature of its tensor."""
    return jpeg.digest(_docs(spark, sf_dir))


def op6_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.sharded(_docs(spark, sf_dir).select("doc_id", "text"), SHARD_BYTES).drop("text")


def op7_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, as read back from the archive."""
    return warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the pieces of every text and of what they decode to."""
    return pieces.digest(_docs(spark, sf_dir), piece_model())


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECE_MODEL)


_ALL = (op1_minhash_near_dedup, op2_quality_rules, op3_toxicity, op4_mix_sources, op5_progressive_jpeg, op6_shard_documents, op7_warc_records, op8_substring_dedup, op9_secret_scan, op10_sentencepiece)
QUERIES = {f.__name__: f for f in _ALL}

ORACLE_SQL: dict[str, str] = {"op1_minhash_near_dedup": near_dedup.oracle(3, 85, 100), "op4_mix_sources": mixing.ORACLE, "op6_shard_documents": sharding.oracle(SHARD_BYTES), "op7_warc_records": warc.ORACLE, "op8_substring_dedup": substring_dedup.ORACLE}
