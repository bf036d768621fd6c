"""Boxes, projections and shapes as column expressions. Boxes are arrays x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounds of a usable mask.
MIN_AREA, MAX_AREA, MAX_ASPECT, MIN_LABEL_AREA = 0.0004, 0.40, 6.0, 0.0008


def _d(x) -> Column:
    return (F.lit(x) if not isinstance(x, Column) else x).cast("double")


def xyxy(x0, y0, x1, y1) -> Column:
    return F.array(_d(x0), _d(y0), _d(x1), _d(y1))


def box_area(box: Column) -> Column:
    return F.greatest(box[2] - box[0], F.lit(0.0)) * F.greatest(box[3] - box[1], F.lit(0.0))


def box_overlap(a: Column, b: Column) -> Column:
    wide = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    high = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(wide, F.lit(0.0)) * F.greatest(high, F.lit(0.0))


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 for two empty boxes."""
    both = box_overlap(a, b)
    return both / F.greatest(box_area(a) + box_area(b) - both, F.lit(1e-9))


def clamp_box(box: Column, width, height) -> Column:
    """A box inside the image; its far corner is at least 1."""
    w, h = _d(width), _d(height)

    def within(v: Column, lo: float, hi: Column) -> Column:
        return F.greatest(F.lit(lo), F.least(v, hi))

    return F.array(within(box[0], 0.0, w - 1), within(box[1], 0.0, h - 1), within(box[2], 1.0, w), within(box[3], 1.0, h))


def large_enough(box: Column, least: float = 3.0, inclusive: bool = False) -> Column:
    """Both sides exceed ``least`` pixels (or reach it)."""
    a, b = box[2] - box[0], box[3] - box[1]
    return (a >= least) & (b >= least) if inclusive else (a > least) & (b > least)


def aspect_ratio(box: Column) -> Column:
    """The longer side over the shorter one; sides count as at least a pixel."""
    w, h = F.greatest(box[2] - box[0], F.lit(1.0)), F.greatest(box[3] - box[1], F.lit(1.0))
    return F.greatest(w / h, h / w)


def area_fraction(area: Column, width, height) -> Column:
    return area / F.greatest(_d(width) * _d(height), F.lit(1.0))


def touched_borders(box: Column, width, height) -> Column:
    sides = (box[0] <= 1, box[1] <= 1, box[2] >= _d(width) - 1, box[3] >= _d(height) - 1)
    return sum((s.cast("int") for s in sides[1:]), sides[0].cast("int"))


def mask_gate(area: Column, box: Column, width, height) -> Column:
    """Whether a mask's area, shape and borders are those of an object."""
    part = area_fraction(area, width, height)
    return (part > MIN_AREA) & (part <= MAX_AREA) & (aspect_ratio(box) <= MAX_ASPECT) & (touched_borders(box, width, height) < 3)


def project(point: Column, focal: Column, width, height) -> Column:
    """Camera point (array x, y, z) to pixels; the principal point is the image centre."""
    z = F.greatest(point[2], F.lit(1e-4))
    return F.array(focal * point[0] / z + _d(width) / 2, focal * point[1] / z + _d(height) / 2)


def projected(points: Column, focal: Column, width, height) -> Column:
    return F.transform(points, lambda p: project(p, focal, width, height))


def focal_length(configured: Column, profile: Column, profile_id: Column, policy: Column, width, height) -> Column:
    """Struct (focal, provenance): as configured, else of the profile, else 0.8 of the longer side."""
    guess = 0.8 * F.greatest(_d(width), _d(height))
    named = F.format_string("camera profile %s (%s)", F.coalesce(profile_id, F.lit("unknown")), F.coalesce(policy, F.lit("profile policy")))
    origin = F.when(configured.isNotNull(), "user-supplied calibrated effective focal length").when(profile.isNotNull(), named).otherwise("image-size heuristic")
    return F.struct(F.coalesce(configured, profile, guess).alias("focal"), origin.alias("provenance"))


def camera_translation(scale: Column, tx: Column, ty: Column, box: Column, size: Column, focal: Column, width, height) -> Column:
    """Weak-perspective parameters of a crop to a translation in the full camera."""
    cx, cy = (box[0] + box[2]) / 2, (box[1] + box[3]) / 2
    dx, dy = 2 * (cx - _d(width) / 2) / (size + 1e-9), 2 * (cy - _d(height) / 2) / (size + 1e-9)
    return F.array(tx + dx / scale, ty + dy / scale, 2 * focal / (size * scale + 1e-9))


def scaled_side(width, height, longest) -> Column:
    """The factor that brings the longer side to at most ``longest``."""
    return F.least(F.lit(1.0), _d(longest) / F.greatest(_d(width), _d(height)))


def normalised(v: Column) -> Column:
    """A vector over its length, in doubles; a zero vector stays."""
    v = v.cast("array<double>")
    length = F.greatest(F.sqrt(dot(v, v)), F.lit(1e-9))
    return F.transform(v, lambda x: x / length)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def finite(v: Column) -> Column:
    """Whether every number of an array is there and finite."""
    return F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
