"""Corpus preparation: toxicity, near duplicates, secrets, mixture, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last return the columns of ``documents``; ``run`` writes what each returns into the shared
work folder and hands the next one what it reads back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from egolake.llm import mixing, near_dedup, pieces, queries, secret_scan, toxicity
from egolake.llm.work import hinted, materialize

#: Words of a shingle, and similarity in hundredths, at which documents are near duplicates.
SHINGLE_WORDS, SIMILAR = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go; the labels beside them are learnt from."""
    scored = toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document of smallest id stays.

    Rows that share an id stay or go together; rows of null ids stay.
    """
    found = near_dedup.near_duplicates(docs, shingle=SHINGLE_WORDS, num=SIMILAR, den=100)
    gone = found.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept and doc_id is not null").select("doc_id")
    gone = materialize(gone, "gone")
    return docs.join(hinted(gone, F.lit(24)), "doc_id", "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture."""
    return mixing.mixed(docs, most=None)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text with their spans of its UTF-8 bytes, and its position in the mixture.

    Files keep no order, and stages hand on the columns of ``documents`` alone, so the position
    is computed again: it is a fixed function of the rows.
    """
    placed = mixing.scheduled(docs, most=None).select("doc_id", "lang", "source", "position", "text")
    out = pieces.encoded(placed, queries.piece_model())
    return out.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: No stage but the fourth could be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
