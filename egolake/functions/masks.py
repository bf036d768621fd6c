"""Run-length masks: column-major counts that start with a background run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rle_area(counts: Column) -> Column:
    """Pixels of a mask: the runs at odd places."""
    return F.aggregate(F.filter(counts, lambda _, i: i % 2 == 1), F.lit(0).cast("long"), lambda s, c: s + c)


def rle_decode(counts: Column) -> Column:
    """Pixels 0 and 1 in column-major order."""
    return F.flatten(F.transform(counts, lambda c, i: F.array_repeat((i % 2).cast("int"), c.cast("int"))))


def rle_encode(pixels: Column) -> Column:
    """Counts of runs; the first run is of zeros and may be empty. No pixels give no runs.

    Pixels and the places where they change are bound to variables of lambdas: a lambda's body
    runs for each element, and expressions in it that don't depend on the element with it.
    """
    none = F.array().cast("array<int>")

    def counts(p: Column) -> Column:
        changes = F.array_compact(F.transform(p, lambda v, i: F.when(v.cast("int") != F.get(p, i - 1).cast("int"), i)))
        runs = _lengths(_bound(changes, lambda c: F.concat(F.array(F.lit(0)), c, F.array(F.size(p)))))
        zero = F.when(F.get(p, F.lit(0)).cast("int") == 1, F.array(F.lit(0))).otherwise(none)
        return F.when(F.size(p) > 0, F.concat(zero, runs)).otherwise(none)

    return _bound(pixels, counts)


def rle_from_places(places: Column, size: int) -> Column:
    """Counts of runs of a mask of ``size`` pixels, from the places (column-major, from 0, in any order) of those that are set.

    As ``rle_encode`` of its pixels, in time by the set pixels. Places outside of the mask count for nothing.
    """
    none = F.array().cast("array<int>")

    def edges(p: Column) -> Column:
        first = lambda v, i: F.when((i == 0) | (F.get(p, i - 1) != v - 1), F.array(v)).otherwise(none)
        past = lambda v, i: F.when((i == F.size(p) - 1) | (F.get(p, i + 1) != v + 1), F.array(v + 1)).otherwise(none)
        return F.flatten(F.transform(p, lambda v, i: F.concat(first(v, i), past(v, i))))

    known = F.sort_array(F.array_distinct(F.filter(places, lambda v: (v >= 0) & (v < size)))).cast("array<int>")
    rest = lambda e: F.when(F.coalesce(F.get(e, F.size(e) - 1), F.lit(0)) < size, F.array(F.lit(size))).otherwise(none)
    return _lengths(_bound(_bound(known, edges), lambda e: F.concat(F.array(F.lit(0)), e, rest(e))))


def _lengths(ends: Column) -> Column:
    """From each place to the next."""
    return _bound(ends, lambda e: F.zip_with(F.slice(e, 2, F.size(e) - 1), F.slice(e, 1, F.size(e) - 1), lambda b, a: b - a))


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def rle_box(counts: Column, height) -> Column:
    """x, y, width, height of a mask from its runs; zeros for an empty mask.

    A run that passes the end of a column spans all rows. One pass over the runs.
    """
    h = (height if isinstance(height, Column) else F.lit(height)).cast("long")
    none = F.lit(None).cast("long")
    start = F.struct(F.lit(0).cast("long").alias("p"), F.lit(False).alias("on"), *(none.alias(k) for k in ("x0", "x1", "y0", "y1")))

    def step(s: Column, c: Column) -> Column:
        a, b = s["p"], s["p"] + c - 1
        xa, xb = F.floor(a / h), F.floor(b / h)
        seen = s["on"] & (c > 0)
        low = lambda k, v: F.when(seen, F.least(s[k], v)).otherwise(s[k]).alias(k)
        high = lambda k, v: F.when(seen, F.greatest(s[k], v)).otherwise(s[k]).alias(k)
        y0 = F.when(xa != xb, F.lit(0).cast("long")).otherwise(a % h)
        y1 = F.when(xa != xb, h - 1).otherwise(b % h)
        return F.struct((s["p"] + c).alias("p"), (~s["on"]).alias("on"), low("x0", xa), high("x1", xb), low("y0", y0), high("y1", y1))

    zero = F.lit(0).cast("long")
    box = lambda s: F.when(s["x0"].isNull(), F.array(zero, zero, zero, zero)).otherwise(F.array(s["x0"], s["y0"], s["x1"] - s["x0"] + 1, s["y1"] - s["y0"] + 1))
    return F.aggregate(counts, start, step, box)


def rle_corners(counts: Column, height) -> Column:
    """x0, y0, x1, y1 of a mask, the far corner outside of it; zeros for an empty mask."""
    box = rle_box(counts, height)
    return F.transform(F.array(box), lambda b: F.array(b[0], b[1], b[0] + b[2], b[1] + b[3]))[0]
