"""Bounded samples of labelled documents, from which models are fitted."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import python_ready

#: Labelled documents at most, and characters of a document at most, that a model is fitted on.
SAMPLE_DOCS, SAMPLE_CHARS = 10_000, 60_000


def fold(doc_id: int) -> int:
    """0 to 4; 0 is held out and never learnt from."""
    return crc32(str(doc_id).encode()) % 5


def sample_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int = SAMPLE_DOCS) -> DataFrame:
    """Rows (doc_id, text, y) of at most ``limit`` labelled documents that are not held out.

    The ids are the first by a hash, so the sample doesn't depend on the order of rows. Null
    labels, ids and texts and texts of over SAMPLE_CHARS are not sampled; of rows that repeat
    an id the least text and the least label are taken.
    """
    key = F.crc32(F.col("doc_id").cast("string"))
    ids = labels.where(F.col("doc_id").isNotNull() & (key % 5 != 0) & F.col(label).isin(0, 1))
    ids = ids.groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("y")).select("doc_id", "y", F.xxhash64(F.col("doc_id")).alias("h"))
    chosen = F.broadcast(ids.orderBy("h", "doc_id").limit(limit).select("doc_id", "y"))
    rows = docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS).join(chosen, "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))


def learnt(rows: DataFrame, train: Callable[[list[tuple]], object]) -> object:
    """What ``train`` makes of the sorted rows, in one task of an executor: the driver gets the model alone.

    No rows are an empty list. The rows are a bounded sample.
    """
    python_ready(rows.sparkSession)

    def run(batches):
        got = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(got))], pa.binary())], names=["model"])

    got = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0].model) if got else train([])
