"""Scalars: text, rates, counts and hashes."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Overlay colours, by object id.
PALETTE = ((0, 210, 255), (255, 80, 110), (100, 230, 120), (190, 110, 255), (255, 190, 50), (40, 150, 255))
# Detection prompts where no labels are given.
BROAD_PROMPTS = (
    "tool", "hand tool", "object", "small object", "equipment", "instrument", "implement", "device", "part", "component", "piece",
    "attachment", "workpiece", "block", "bar", "rod", "tube", "plate", "sheet", "fastener", "hardware", "fixture",
)


def comma_list(text: Column) -> Column:
    """Trimmed parts of a comma list; blank ones are dropped."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def key_value(text: Column) -> Column:
    """Struct (key, value) of ``KEY=value``; null without a sign or with an empty side."""
    part = F.split(text, "=", 2)
    key, value = F.trim(part[0]), F.trim(F.get(part, F.lit(1)))
    return F.when((F.size(part) == 2) & (key != "") & (value != ""), F.struct(key.alias("key"), value.alias("value")))


def distinct_prompts(prompts: Column) -> Column:
    """Trimmed prompts without blanks and repeats, in their order."""
    return F.array_distinct(F.filter(F.transform(prompts, lambda p: F.trim(p)), lambda p: p != ""))


def chosen_prompts(labels: Column, broad: Sequence[str] = BROAD_PROMPTS) -> Column:
    """The trimmed labels if there are any, else the broad list."""
    own = F.filter(F.transform(labels, lambda p: F.trim(p)), lambda p: p != "")
    return F.when(F.size(labels) > 0, own).otherwise(distinct_prompts(F.array(*map(F.lit, broad))))


def rate(text: Column) -> Column:
    """A rational like 30000/1001 as a number; 0 where it isn't one."""
    part = F.split(text, "/")
    top = part[0].try_cast("double")
    low = F.coalesce(F.get(part, F.lit(1)).try_cast("double"), F.when(F.size(part) == 1, F.lit(1.0)))
    return F.coalesce(F.try_divide(top, low), F.lit(0.0))


def common_divisor(a: Column, b: Column) -> Column:
    """The greatest common divisor of two whole numbers, 0 for two zeros, by Euclid's steps.

    Fibonacci numbers are the worst case: 45 steps are enough below 2**31.
    """
    start = F.struct(F.abs(a).cast("long").alias("a"), F.abs(b).cast("long").alias("b"))
    step = lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), (s["a"] % s["b"]).alias("b")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(48)), start, step, lambda s: s["a"])


def aspect_text(width: Column, height: Column) -> Column:
    """Sides by their common divisor, like 16:9."""
    g = F.greatest(common_divisor(width, height), F.lit(1))
    return F.concat_ws(":", (width / g).cast("long"), (height / g).cast("long"))


def frame_count(frames: Column, duration: Column, fps: Column) -> Column:
    """As stated in digits, else the duration times the rate, rounded half to even, at least 1."""
    return F.when(frames.rlike("^[0-9]+$"), frames.try_cast("long")).otherwise(F.greatest(F.coalesce(F.bround(duration * fps).cast("long"), F.lit(1)), F.lit(1)))


def frame_file(index: Column, folder: str, suffix: str) -> Column:
    return F.format_string(f"{folder}/%08d.{suffix}", index)


def file_safe(text: Column, longest: int = 60) -> Column:
    return F.substring(F.replace(text, F.lit("/"), F.lit("_")), 1, longest)


def colour(object_id: Column) -> Column:
    table = F.array(*(F.array(*map(F.lit, c)) for c in PALETTE))
    return F.element_at(table, (F.pmod(object_id, F.lit(len(PALETTE))) + 1).cast("int"))


def reason(entity: Column, name: str, prefix: str = "") -> Column:
    return F.format_string(f"{prefix}%s_{name}", entity.cast("string"))


def file_sha256(content: Column) -> Column:
    """Null where there is no content."""
    return F.when(content.isNotNull(), F.sha2(content, 256))


def stable_hash(config: Mapping) -> str:
    """The first 16 hex digits of the SHA-256 of a configuration as JSON with sorted keys."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:16]


def compact_hash(value) -> str:
    """As ``stable_hash``, without spaces in the JSON."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]


def segment_key(object_id: int, start: int, end: int, size: int, direction: str, mem_every: int, max_mem: int, mask_rle: Mapping) -> str:
    """The file name under which a propagated interval is kept."""
    return f"object_{object_id}_{start}_{end}_{direction}_{compact_hash(mask_rle)}_{size}_m{mem_every}_w{max_mem}.npz"
