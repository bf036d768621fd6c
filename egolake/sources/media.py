"""Video as a data source. Decoding needs the ffmpeg programs; parsing doesn't."""

from __future__ import annotations

import json
import re
import shutil
import subprocess
import tempfile
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from ..functions.values import frame_count, rate

TIME = r"pts_time:([^\s]+)"
END_OF_IMAGE = b"\xff\xd9"
#: Rate where a stream doesn't tell one.
FALLBACK_FPS = 30.0


class MissingDecoder(RuntimeError):
    """The ffmpeg programs aren't installed."""


def _program(name: str) -> str:
    found = shutil.which(name)
    if not found:
        raise MissingDecoder(f"{name} is needed to read video")
    return found


def _probe(video: str, *what: str, program: str = "ffprobe") -> bytes:
    return subprocess.run([_program(program), "-v", "error", "-select_streams", "v:0", *what, video], check=True, capture_output=True).stdout


def probe(video: str, program: str = "ffprobe") -> dict:
    """The first video stream's metadata."""
    doc = json.loads(_probe(video, "-show_streams", "-show_format", "-of", "json", program=program))
    if not doc.get("streams"):
        raise ValueError(f"{video} has no video stream")
    return doc["streams"][0] | {"format": doc.get("format", {})}


def stream_rate(stream: dict) -> float:
    """Frames a second, 0 where the stream doesn't tell."""
    for name in ("avg_frame_rate", "r_frame_rate"):
        try:
            found = float(Fraction(str(stream.get(name) or "0")))
        except (ValueError, ZeroDivisionError):
            found = 0.0
        if found > 0:
            return found
    return 0.0


def stated_frames(stream: dict) -> int:
    """As stated in digits, else the duration times the rate, rounded half to even, at least 1."""
    stated = str(stream.get("nb_frames", ""))
    if re.fullmatch("[0-9]+", stated):
        return int(stated)
    duration = stream.get("duration") or stream.get("format", {}).get("duration") or 0
    return max(1, round(float(duration) * stream_rate(stream)))


def packets(video: str, program: str = "ffprobe") -> tuple[list[float], list[int]]:
    """The times of all frames in order of presentation, and which of them decoding can start at.

    Empty where a packet has no time. Packets are listed without decoding.
    """
    found = []
    for line in _probe(video, "-show_entries", "packet=pts_time,flags", "-of", "csv=p=0", program=program).decode().split():
        time, _, flags = line.partition(",")
        try:
            found.append((float(time), "K" in flags))
        except ValueError:
            return [], []
    found.sort()
    return [t for t, _ in found], [i for i, (_, k) in enumerate(found) if k]


def log_times(lines: DataFrame, value: str = "value") -> DataFrame:
    """Times in a decoder's log lines; lines without a number are left out."""
    return lines.select("*", F.regexp_extract(value, TIME, 1).try_cast("double").alias("timestamp_s")).where("timestamp_s is not null")


def usable_times(times: Sequence[float], frames: int, fps: float) -> list[float]:
    """The decoder's times, or i / fps where their count isn't that of the frames."""
    return list(times) if len(times) == frames else [i / (fps or FALLBACK_FPS) for i in range(frames)]


def stream_values(stream: Column) -> Column:
    """Struct (fps, frames) of a stream's metadata (nb_frames, duration, avg_frame_rate, r_frame_rate)."""
    fps = F.coalesce(F.nullif(rate(F.coalesce(stream["avg_frame_rate"], stream["r_frame_rate"], F.lit("0/1"))), F.lit(0.0)), F.lit(0.0))
    return F.struct(fps.alias("fps"), frame_count(stream["nb_frames"], stream["duration"].try_cast("double"), fps).alias("frames"))


class Frames(InputPartition):
    """Frames to decode (ascending), their times, and the frame and time that decoding starts at."""

    def __init__(self, wanted: Sequence[int], times: Sequence[float], start: int, seek: float | None):
        self.wanted, self.times, self.start, self.seek = list(wanted), list(times), start, seek


def _selected(wanted: Sequence[int]) -> str:
    """A filter for these frames: runs of consecutive ones as ranges."""
    runs: list[list[int]] = []
    for i in wanted:
        if runs and i == runs[-1][1] + 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return "+".join(f"between(n\\,{a}\\,{b})" for a, b in runs)


class FrameReader(DataSourceReader):
    """Reads JPEG frames of a video in ranges, or only those that a filter names.

    A range is decoded from the last key frame at or before it, and its images are handed on
    one by one. Times are those of the packets; where there is not one for each frame, frame i
    of the whole video is at i / rate.
    """

    def __init__(self, options: dict):
        self.video, self.per = options["path"], int(options.get("frames_per_partition", "500"))
        self.ffprobe, self.ffmpeg = options.get("ffprobe", "ffprobe"), options.get("ffmpeg", "ffmpeg")
        self.wanted: set[int] | None = None

    def pushFilters(self, filters):
        for f in filters:
            values = f.value if isinstance(f, In) else [f.value] if isinstance(f, EqualTo) else None
            if values is not None and f.attribute == ("frame_index",):
                got = set(map(int, values))
                self.wanted = got if self.wanted is None else self.wanted & got
            else:
                yield f

    def partitions(self):
        stream = probe(self.video, self.ffprobe)
        times, keys = packets(self.video, self.ffprobe)
        stated = stated_frames(stream)
        n = stated if str(stream.get("nb_frames", "")).isdigit() else len(times) or stated
        if len(times) != n:
            keys = []
        times = usable_times(times, n, stream_rate(stream))
        frames = range(n) if self.wanted is None else sorted(i for i in self.wanted if 0 <= i < n)
        out, part = [], []
        for i in frames:  # frames of a stretch of the video go to one partition
            if part and (len(part) >= self.per or i - part[0] >= self.per):
                out.append(part)
                part = []
            part.append(i)
        return [self._from(p, times, keys) for p in ([*out, part] if part else out)]

    @staticmethod
    def _from(wanted: list[int], times: list[float], keys: list[int]) -> Frames:
        k = bisect_right(keys, wanted[0]) - 1
        start = keys[k] if k >= 0 else 0
        return Frames(wanted, [times[i] for i in wanted], start, times[start] if start else None)

    def read(self, partition: Frames) -> Iterator[tuple]:
        seek = [] if partition.seek is None else ["-noaccurate_seek", "-ss", f"{partition.seek + 0.0005:.6f}"]
        chosen = f"select={_selected([i - partition.start for i in partition.wanted])}"
        command = [_program(self.ffmpeg), "-v", "error", *seek, "-i", self.video, "-vf", chosen, "-frames:v", str(len(partition.wanted)), "-vsync", "passthrough", "-f", "image2pipe", "-c:v", "mjpeg", "-q:v", "2", "-"]
        with tempfile.TemporaryFile() as log, subprocess.Popen(command, stdout=subprocess.PIPE, stderr=log) as run:
            got = 0
            for image in _images(run.stdout):
                if got < len(partition.wanted):
                    yield partition.wanted[got], partition.times[got], image
                got += 1
            failed = run.wait()
            log.seek(0)
            if failed or got != len(partition.wanted):
                raise ValueError(f"decoded {got} of {len(partition.wanted)} frames of {self.video} from {partition.wanted[0]} on: {log.read(2000).decode(errors='replace')}")


def _images(pipe) -> Iterator[bytes]:
    """JPEG images of a stream of them; markers do not occur inside coded data."""
    held = b""
    while data := pipe.read(1 << 16):
        *whole, held = (held + data).split(END_OF_IMAGE)
        yield from (w + END_OF_IMAGE for w in whole)


class FrameSource(DataSource):
    """``spark.read.format("video_frames").load(path)``: frame_index, timestamp_s, content.

    Options: frames_per_partition, and ffprobe and ffmpeg, where the programs aren't on the path of the workers.
    """

    @classmethod
    def name(cls) -> str:
        return "video_frames"

    def schema(self) -> str:
        return "frame_index bigint, timestamp_s double, content binary"

    def reader(self, schema) -> FrameReader:
        return FrameReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the source known; filters on frame_index then reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FrameSource)


def render(images: Sequence[str], output: str, fps: float) -> str:
    """An MP4 of image files, with the first encoder of the list that works; returns its name."""
    listing = "".join(f"file '{p}'\nduration {1 / fps:.9f}\n" for p in images)
    errors = []
    with tempfile.NamedTemporaryFile("w", suffix=".txt") as f:
        f.write(listing)
        f.flush()
        for encoder in ("h264_videotoolbox", "h264_nvenc", "libx264"):
            done = subprocess.run([_program("ffmpeg"), "-y", "-v", "error", "-f", "concat", "-safe", "0", "-i", f.name, "-c:v", encoder, "-pix_fmt", "yuv420p", output], capture_output=True)
            if done.returncode == 0:
                return encoder
            errors.append(done.stderr.decode(errors="replace")[:300])
    raise RuntimeError(f"no encoder could write {output}: {errors}")
