"""Shared work folder, materialised steps and size-checked broadcasts.

Steps are written as Parquet into the folder that the cluster names in
``spark.checkpoint.dir``, which every executor can read, so a lost executor costs
only the tasks it was running. A folder of this process's own is set only where the
setting is empty, as in local tests.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a measured side of a join is broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 48 << 20
#: Keys that are joined apart from the others at most, by a broadcast.
HEAVY_KEYS = 20_000

_own: list[str] = []
_used: dict[str, object] = {}  # folders of this process's steps, and the file systems they are on


def work_root(spark: SparkSession) -> str:
    """The folder of this process's steps in the shared folder, which is removed when the process ends.

    Where ``spark.checkpoint.dir`` is empty, a local folder serves a local master; on a cluster
    every executor would write to a disk of its own, so that is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="egolake-work-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        base = "file://" + _own[0]
    root = f"{base.rstrip('/')}/egolake-{spark.sparkContext.applicationId}-{os.getpid()}"
    if root not in _used:
        if not _used:
            atexit.register(clean)
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        _used[root] = path.getFileSystem(spark._jsc.hadoopConfiguration()), path
    return root


def clean() -> None:
    """Remove the tables that this process's steps have written; frames that read them can't be used any more."""
    while _used:
        _, (system, path) = _used.popitem()
        try:
            system.delete(path, True)
        except Exception:  # noqa: BLE001, S112  the process ends, and its JVM may have before
            continue


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back, which cuts its lineage.

    ``codec`` compresses the files, in place of the session's.
    """
    spark = df.sparkSession
    path = f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame, row_bytes) -> int:
    """Bytes of ``df`` by a per-row size expression, counted over all its rows."""
    return int(df.agg(F.sum(row_bytes)).first()[0] or 0)


def hinted(df: DataFrame, row_bytes, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is at most ``limit`` (BROADCAST_BYTES), else as it is."""
    return F.broadcast(df) if measured_bytes(df, row_bytes) <= (BROADCAST_BYTES if limit is None else limit) else df


def keyed(left: DataFrame, right: DataFrame, key: str, row_bytes: int) -> DataFrame:
    """``left`` with the columns of ``right`` (one row a key), null where it lacks the key.

    ``right`` has a column rows, the rows of ``left`` with the key. A small ``right`` is
    broadcast. Otherwise keys with more than one in HEAVY_KEYS of all those rows (there are
    fewer than HEAVY_KEYS such) are joined by a broadcast, and their rows are scattered in the
    shuffle that joins the rest, so that no key gathers in one task.
    """
    n, total = right.agg(F.count("*"), F.sum("rows")).first()
    side = right.drop("rows")
    if n * row_bytes <= BROADCAST_BYTES:
        return left.join(F.broadcast(side), key, "left")
    cols = [c for c in side.columns if c != key]
    heavy = F.col("rows") * HEAVY_KEYS > total
    a = right.where(heavy).select(key, F.struct(*cols).alias("_heavy"))
    b = right.where(~heavy).select(F.col(key).alias("_key"), F.struct(*cols).alias("_light"))
    kind = left.schema[key].dataType
    near = F.coalesce(F.col("_heavy").isNull(), F.lit(True))
    scattered = F.when(near, F.col(key)).otherwise(F.xxhash64(*left.columns).cast("string").cast("binary").cast(kind) if kind.typeName() == "binary" else F.xxhash64(*left.columns).cast(kind))
    out = left.join(F.broadcast(a), key, "left").withColumn("_near", scattered)
    out = out.join(b, (F.col("_near") == F.col("_key")) & near, "left")
    return out.select(*left.columns, *(F.coalesce(F.col("_heavy")[c], F.col("_light")[c]).alias(c) for c in cols))
