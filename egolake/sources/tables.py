"""Readers of stored tables and documents, always with a schema."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table; a missing path and files without bytes have no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stored(spark: SparkSession, job: str, name: str, path: str) -> DataFrame:
    return read_table(spark, f"{job}/{path}", TABLES[name])


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, one row each; a field that isn't there is null."""
    try:
        return spark.read.schema(schema).json(path, multiLine=True)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def quality_frames(spark: SparkSession, path: str) -> DataFrame:
    """Frames of a stage's quality document."""
    doc = read_document(spark, path, "frames array<struct<frame_index: bigint, confidence: double, status: string, reasons: array<string>>>")
    none = F.array().cast("array<string>")
    return doc.select(F.explode("frames").alias("f")).select("f.frame_index", "f.confidence", "f.status", F.coalesce("f.reasons", none).alias("reasons"))


def quarantined_intervals(spark: SparkSession, path: str) -> DataFrame:
    doc = read_document(spark, path, "quarantined_intervals array<struct<start_frame: bigint, end_frame: bigint, reasons: array<string>>>")
    return doc.select(F.explode("quarantined_intervals").alias("q")).select("q.*")


def masks(spark: SparkSession, path: str) -> DataFrame:
    doc = read_document(spark, path, "annotations array<struct<frame_index: bigint, object_id: bigint, instance_id: bigint, rle: struct<size: array<int>, counts: array<int>>>>")
    return doc.select(F.explode("annotations").alias("a")).select("a.*")


def frame_images(spark: SparkSession, folder: str, pattern: str = "*.jpg") -> DataFrame:
    """Image files of a folder: frame_index from the name, path, content; file order is frame order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.regexp_extract("path", r"(\d+)\.\w+$", 1).cast("long").alias("frame_index"), "path", "content")


def tensors(files: DataFrame, name: str, content: str = "content") -> DataFrame:
    """The array ``name`` of NPZ files: its shape and its values as doubles, beside the path."""

    def run(batches):
        for b in batches:
            got = [np.load(io.BytesIO(c), allow_pickle=False)[name] for c in b[content]]
            yield pd.DataFrame({"path": b["path"], "shape": [list(map(int, a.shape)) for a in got], "values": [a.astype(float).ravel().tolist() for a in got]})

    return files.select("path", content).mapInPandas(run, "path string, shape array<int>, values array<double>")
