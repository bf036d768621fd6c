"""The quality report: stages in one table, with times, counts and quarantined intervals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import merge_intervals


def stage_rows(stages: Mapping[str, DataFrame | None]) -> DataFrame:
    """All rows of the stages that are there, each tagged with its stage."""
    tagged = [df.withColumn("stage", F.lit(name)) for name, df in stages.items() if df is not None]
    if not tagged:
        raise ValueError("no stage has rows")
    return reduce(DataFrame.unionByName, tagged)


def with_timestamps(rows: DataFrame, frames: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows with the time of their frame; ``unmatched_frames`` finds those without one."""
    return rows.join(frames.select(*keys, "frame_index", "timestamp_s"), [*keys, "frame_index"])


def unmatched_frames(rows: DataFrame, frames: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return rows.join(frames.select(*keys, "frame_index"), [*keys, "frame_index"], "left_anti")


def status_counts(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*keys, "stage", "status").agg(F.count("*").alias("frames"))


def quarantined(rows: DataFrame, keys: Sequence[str] = ("stage",)) -> DataFrame:
    """Intervals of consecutive rejected frames."""
    return merge_intervals(rows.where("status = 'rejected'"), keys)
