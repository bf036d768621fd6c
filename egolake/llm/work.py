"""The engine's shared work folder and size-checked joins, and Arrow batches that hold little text."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from ..work import hinted, keyed, materialize, measured_bytes

__all__ = ["ARROW_BYTES", "ARROW_ROWS", "hinted", "keyed", "materialize", "measured_bytes", "python_ready"]

#: Rows and bytes that one Arrow batch carries to Python at most (a longer row is a batch of its own).
ARROW_ROWS, ARROW_BYTES = 256, 4 << 20


def python_ready(spark: SparkSession) -> None:
    """Let Python workers import this package, and bound the rows of an Arrow batch."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join([root, *([have] if have else [])])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
