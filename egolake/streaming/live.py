"""The report on a live stream of quality frames: counts by window, and intervals as they close."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def status_counts(frames: DataFrame, late: str = "10 minutes", window: str = "1 minute") -> DataFrame:
    """Frames (ts, stage, status) by window, stage and status; later ones than ``late`` are dropped."""
    rows = frames.withWatermark("ts", late)
    return rows.groupBy(F.window("ts", window), "stage", "status").agg(F.count("*").alias("frames")).select("window.start", "window.end", "stage", "status", "frames")


def closed_intervals(frames: DataFrame, late: str = "10 minutes", idle: float = 5.0) -> DataFrame:
    """Intervals of consecutive rejected frames (ts, track, frame_index, reasons), emitted when they are over.

    Frames may come in any order; those later than ``late`` are dropped. An interval is over
    when the watermark is ``idle`` seconds past its last frame, the longest time that
    neighbouring frames are apart. A track's frames are kept until then, and its last interval
    comes out by the same time limit.
    """
    schema = "track bigint, start_frame bigint, end_frame bigint, reasons array<string>"
    wait = int(idle * 1000)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(zip(*state.get, strict=True)) if state.exists else []
        if not state.hasTimedOut:
            for b in batches:
                held += [(int(i), int(t.timestamp() * 1000), json.dumps(list(why))) for i, t, why in b[["frame_index", "ts", "reasons"]].itertuples(index=False)]
        held.sort()
        runs: list[list[tuple]] = []
        for row in held:
            if runs and row[0] <= runs[-1][-1][0] + 1:
                runs[-1].append(row)
            else:
                runs.append([row])
        now = state.getCurrentWatermarkMs()
        last = lambda run: max(t for _, t, _ in run)
        over = [r for r in runs if last(r) + wait <= now]
        left = [r for r in runs if last(r) + wait > now]
        if left:
            state.update(tuple(list(c) for c in zip(*(row for r in left for row in r), strict=True)))
            state.setTimeoutTimestamp(min(last(r) for r in left) + wait + 1)
        elif state.exists:
            state.remove()
        out = [(key[0], r[0][0], r[-1][0], sorted({x for *_, why in r for x in json.loads(why)})) for r in over]
        yield pd.DataFrame(out, columns=["track", "start_frame", "end_frame", "reasons"])

    rows = frames.withWatermark("ts", late).select("track", "frame_index", "ts", "reasons")
    return rows.groupBy("track").applyInPandasWithState(step, schema, "i array<bigint>, t array<bigint>, why array<string>", "append", GroupStateTimeout.EventTimeTimeout)
