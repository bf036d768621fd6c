"""Operators on ordered tracks: runs, gaps, derivatives, intervals.

Every window is partitioned by the keys of a track, so tracks run in parallel; none of the
operators gathers a table in one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Default rate where timestamps don't tell one.
FALLBACK_FPS = 30.0


def _over(keys: Sequence[str], *order: str):
    if not keys:
        raise ValueError("a track needs at least one key")
    return Window.partitionBy(*keys).orderBy(*order)


def with_islands(df: DataFrame, keys: Sequence[str], index: str = "frame_index", step: int = 1, name: str = "island") -> DataFrame:
    """Number the runs of rows whose index follows the last one by ``step``; a repeat starts a new run."""
    w = _over(keys, index)
    begins = F.coalesce(F.col(index) != F.lag(index).over(w) + step, F.lit(True))
    return df.withColumn(name, F.sum(begins.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def merge_intervals(df: DataFrame, keys: Sequence[str], index: str = "frame_index", reasons: str = "reasons") -> DataFrame:
    """Consecutive frames as inclusive intervals with the sorted union of their reasons."""
    runs = with_islands(df, keys, index, name="_island")
    union = F.array_sort(F.array_distinct(F.flatten(F.collect_list(reasons))))
    out = runs.groupBy(*keys, "_island").agg(F.min(index).alias("start_frame"), F.max(index).alias("end_frame"), union.alias("reasons"))
    return out.drop("_island")


def with_runs(df: DataFrame, keys: Sequence[str], active: Column, index: str = "frame_index", name: str = "run") -> DataFrame:
    """Number the runs of rows, in order of index, on which ``active`` holds; null elsewhere."""
    w = _over(keys, index)
    df = df.withColumn("_active", F.coalesce(active, F.lit(False)))
    begins = F.col("_active") & ~F.lag("_active", 1, False).over(w)
    run = F.sum(begins.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(name, F.when(F.col("_active"), run)).drop("_active")


def first_sustained(df: DataFrame, keys: Sequence[str], flag: Column, length: int, index: str = "frame_index") -> DataFrame:
    """Keys and the index at which the first run of ``length`` true rows starts (null if none)."""
    w = _over(keys, index)
    span = w.rowsBetween(1 - length, 0)
    full = (F.sum(F.coalesce(flag, F.lit(False)).cast("int")).over(span) == length) & (F.count("*").over(span) == length)
    at = df.withColumn("_at", F.when(full, F.lag(index, length - 1).over(w)))
    return at.groupBy(*keys).agg(F.min("_at").alias("start"))


def interpolated(df: DataFrame, keys: Sequence[str], value: str, valid: Column, max_gap: int = 5, index: str = "frame_index") -> DataFrame:
    """Fill gaps of at most ``max_gap`` rows between valid rows, linearly by row; adds ``inferred``.

    ``value`` is an array of numbers. Rows of longer or open gaps keep what they have.
    """
    w = _over(keys, index)
    df = df.withColumn("_n", F.row_number().over(w)).withColumn("_ok", F.coalesce(valid, F.lit(False)))
    seen = F.when(F.col("_ok"), F.struct("_n", F.col(value).alias("v")))
    df = df.withColumn("_l", F.last(seen, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    df = df.withColumn("_r", F.first(seen, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)))
    gap = F.col("_r._n") - F.col("_l._n") - 1
    fill = ~F.col("_ok") & F.coalesce(gap <= max_gap, F.lit(False))
    a = (F.col("_n") - F.col("_l._n")) / (gap + 1)
    between = F.zip_with(F.col("_l.v"), F.col("_r.v"), lambda x, y: (1 - a) * x + a * y)
    df = df.withColumn("inferred", fill).withColumn(value, F.when(fill, between).otherwise(F.col(value)))
    return df.drop("_n", "_ok", "_l", "_r")


def suppress_short_runs(df: DataFrame, keys: Sequence[str], least: int = 12, preserve: float = 0.85, index: str = "frame_index") -> DataFrame:
    """Reject runs of fewer than ``least`` rows whose confidence never reaches ``preserve``."""
    df = with_runs(df, keys, F.col("state") != "rejected", index, "_run")
    run = Window.partitionBy(*keys, "_run")
    short = F.col("_run").isNotNull() & (F.count("*").over(run) < least) & (F.max("confidence").over(run) < preserve)
    df = df.withColumn("_short", short)
    df = df.withColumn("state", F.when(F.col("_short"), "rejected").otherwise(F.col("state")))
    return df.withColumn("confidence", F.when(F.col("_short"), F.lit(0.0)).otherwise(F.col("confidence"))).drop("_run", "_short")


def savgol_taps(window: int, order: int) -> np.ndarray:
    """A matrix that smooths ``window`` values: row i fits a polynomial and takes its value at i."""
    basis = np.vander(np.arange(window) - window // 2, order + 1, increasing=True).astype(float)
    return basis @ np.linalg.pinv(basis)


def smoothed(df: DataFrame, keys: Sequence[str], value: str, valid: Column, index: str = "frame_index") -> DataFrame:
    """Savitzky-Golay smoothing of valid runs of at least five rows, order 2, up to nine taps.

    The first and last half window take the fit of the outermost whole window. ``value`` is an
    array of numbers; runs of fewer rows and other rows stay. Windows over one partitioning by
    the keys: a row sees the eight rows before and after it.
    """
    df = with_runs(df, keys, valid, index, "_run")
    run = Window.partitionBy(*keys, "_run")
    df = df.withColumn("_n", F.count("*").over(run)).withColumn("_p", F.row_number().over(run.orderBy(index)) - 1)
    df = df.withColumn("_near", F.collect_list(value).over(run.orderBy(index).rowsBetween(-8, 8)))
    width = F.least(F.lit(9), F.col("_n") - (F.col("_n") + 1) % 2).cast("int")
    begin = F.least(F.greatest(F.col("_p") - F.floor(width / 2), F.lit(0)), F.col("_n") - width)  # of the window in the run
    table = lambda n: F.array(*(F.array(*map(F.lit, row.tolist())) for row in savgol_taps(n, 2)))
    taps = F.when(width == 9, table(9)).when(width == 7, table(7)).otherwise(table(5))
    taps = F.element_at(taps, (F.col("_p") - begin + 1).cast("int"))
    window = F.slice(F.col("_near"), (begin - F.col("_p") + F.least(F.col("_p"), F.lit(8)) + 1).cast("int"), width)
    zero = F.transform(value, lambda x: F.lit(0.0))
    fit = F.aggregate(F.arrays_zip(window.alias("v"), taps.alias("a")), zero, lambda s, x: F.zip_with(s, x["v"], lambda p, q: p + x["a"] * q))
    kind = df.schema[value].dataType
    out = df.withColumn(value, F.when(F.col("_run").isNotNull() & (F.col("_n") >= 5), fit.cast(kind)).otherwise(F.col(value)))
    return out.drop("_run", "_n", "_p", "_near")


def with_slope(df: DataFrame, keys: Sequence[str], value: str, time: str, active: Column, name: str, index: str = "frame_index") -> DataFrame:
    """The derivative of an array over uneven time inside runs of at least two active rows.

    Inner rows weigh both neighbours by the steps to them, outer ones take the one-sided
    difference; other rows are null.
    """
    df = with_runs(df, keys, active, index, "_run")
    w = _over([*keys, "_run"], index)
    prev, nxt = F.lag(F.struct(F.col(time).alias("t"), F.col(value).alias("v"))).over(w), F.lead(F.struct(F.col(time).alias("t"), F.col(value).alias("v"))).over(w)
    df = df.withColumn("_p", prev).withColumn("_q", nxt)
    a, b = F.col(time) - F.col("_p.t"), F.col("_q.t") - F.col(time)

    def each(f: Column, before: Column | None, after: Column | None) -> Column:
        if before is None:
            return (after - f) / b
        if after is None:
            return (f - before) / a
        return (a * a * after + (b * b - a * a) * f - b * b * before) / (a * b * (a + b))

    v, p, q = F.col(value), F.col("_p.v"), F.col("_q.v")
    inner = F.transform(F.arrays_zip(p.alias("p"), v.alias("v"), q.alias("q")), lambda x: each(x["v"], x["p"], x["q"]))
    slope = (
        F.when(F.col("_run").isNull(), None)
        .when(F.col("_p").isNotNull() & F.col("_q").isNotNull(), inner)
        .when(F.col("_q").isNotNull(), F.zip_with(v, q, lambda x, y: each(x, None, y)))
        .when(F.col("_p").isNotNull(), F.zip_with(v, p, lambda x, y: each(x, y, None)))
    )
    return df.withColumn(name, slope).drop("_run", "_p", "_q")


def derivatives(df: DataFrame, keys: Sequence[str], value: str, time: str, valid: Column, index: str = "frame_index") -> DataFrame:
    """Adds velocity and acceleration; the second is taken on runs of finite velocity."""
    from ..functions.geometry import finite

    df = with_slope(df, keys, value, time, valid, "velocity", index)
    known = F.coalesce(F.col("velocity").isNotNull() & finite(F.col("velocity")), F.lit(False))
    return with_slope(df, keys, "velocity", time, known, "acceleration", index)


def durations(df: DataFrame, keys: Sequence[str], fps: float = FALLBACK_FPS, time: str = "timestamp_s", index: str = "frame_index") -> DataFrame:
    """The time to the next frame; the last frame repeats the one before, a single one has 1/fps."""
    w = _over(keys, index)
    df = df.withColumn("_d", F.lead(time).over(w) - F.col(time))
    single = F.lit(1.0 / fps if fps else 1.0 / FALLBACK_FPS)
    return df.withColumn("duration_s", F.coalesce("_d", F.lag("_d").over(w), single)).drop("_d")


def step_flags(df: DataFrame, keys: Sequence[str], index: str = "frame_index") -> DataFrame:
    """is_first, is_last and is_terminal (never) of an episode's steps."""
    w = _over(keys, index)
    last = F.lead(F.lit(1)).over(w).isNull()
    return df.withColumn("is_first", F.row_number().over(w) == 1).withColumn("is_last", last).withColumn("is_terminal", F.lit(False))


def source_fps(df: DataFrame, keys: Sequence[str], time: str = "timestamp_s", index: str = "frame_index") -> DataFrame:
    """Keys and fps: one over the median positive step, 30 where there is none."""
    step = df.withColumn("_d", F.col(time) - F.lag(time).over(_over(keys, index)))
    mid = F.median(F.when(F.col("_d") > 0, F.col("_d")))
    return step.groupBy(*keys).agg(F.coalesce(1.0 / mid, F.lit(FALLBACK_FPS)).alias("fps"))


def lookback(df: DataFrame, keys: Sequence[str], value: Column, name: str, rows: int = 12, index: str = "frame_index") -> DataFrame:
    """The last value that isn't null among the ``rows`` rows before."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(_over(keys, index).rowsBetween(-rows, -1)))


def chunk_ranges(count: Column, size: int, overlap: int) -> Column:
    """Array of (start, end): ranges of ``size`` that overlap; the first that reaches the end is the last."""
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("size must be positive and the overlap smaller")
    step = size - overlap
    starts = F.when(count > 0, F.sequence(F.lit(0).cast("long"), count.cast("long") - 1, F.lit(step).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    ranges = F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(s + size, count.cast("long")).alias("end")))
    return F.filter(ranges, lambda r: (r["start"] == 0) | (r["start"] - step + size < count))


def sample_frames(count: Column, n: int) -> Column:
    """``n`` frames evenly from the first to the last, no more than there are; one is the middle one."""
    some = F.greatest(F.lit(1).cast("long"), F.least(F.lit(n).cast("long"), count.cast("long")))
    even = F.transform(F.sequence(F.lit(0).cast("long"), some - 1), lambda i: F.bround(i * (count - 1) / (some - 1)).cast("long"))
    return F.when(some == 1, F.array(F.floor(count / 2))).otherwise(F.array_distinct(even))


def keyframes(df: DataFrame, stride: int, index: str = "frame_index") -> DataFrame:
    return df.where(F.col(index) % stride == 0)


def in_range(df: DataFrame, count: Column, index: str = "frame_index") -> DataFrame:
    """Frames from 0 to below ``count``."""
    return df.where((F.col(index) >= 0) & (F.col(index) < count))


def expanded(intervals: DataFrame, start: str = "start_frame", end: str = "end_frame", name: str = "frame_index") -> DataFrame:
    """A row for each frame of inclusive intervals."""
    return intervals.withColumn(name, F.explode(F.sequence(start, end)))
