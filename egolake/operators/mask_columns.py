"""Operators on columns of run-length masks (column-major counts, with height and width beside them)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, StructType

from ..functions.values import PALETTE
from . import images, kernels


def by_batch(df: DataFrame, inputs: Sequence[str], result: str, kernel: Callable[..., Sequence[pa.Array]]) -> DataFrame:
    """``df`` with the columns ``result`` (DDL) that ``kernel`` makes of the ``inputs`` of each Arrow batch.

    Columns of those names are replaced.
    """
    added = StructType.fromDDL(result)
    kept = [c for c in df.columns if c not in added.fieldNames()]
    more = [c for c in dict.fromkeys(inputs) if c not in kept]  # others are sent once
    rows = df.select(*kept, *(df[c].alias(f"_in{i}") for i, c in enumerate(more)))
    at, n = [(kept + more).index(c) for c in inputs], len(kept)
    names = [*kept, *added.fieldNames()]

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:n], *kernel(*(b.column(i) for i in at))], names=names)

    return rows.mapInArrow(run, StructType([*df.select(*kept).schema.fields, *added.fields]))


def by_row(df: DataFrame, inputs: Sequence[str], result: str, kernel: Callable[..., tuple]) -> DataFrame:
    """``df`` with the columns ``result`` (DDL) that ``kernel`` makes of each row's ``inputs``, in Arrow batches.

    Columns of those names are replaced.
    """
    kinds = [to_arrow_type(f.dataType) for f in StructType.fromDDL(result).fields]

    def run(*columns):
        got = [kernel(*values) for values in zip(*(c.to_pylist() for c in columns), strict=True)]
        more = list(zip(*got, strict=True)) or [()] * len(kinds)
        return [pa.array(c, k) for c, k in zip(more, kinds, strict=True)]

    return by_batch(df, inputs, result, run)


COUNTS = to_arrow_type(ArrayType(IntegerType()))


def _line(height: pa.Array, width: pa.Array) -> kernels.Line:
    if height.null_count or width.null_count:
        raise ValueError("a mask without a size")
    return kernels.Line(height.to_numpy(zero_copy_only=False), width.to_numpy(zero_copy_only=False))


def _spans(line: kernels.Line, masks: pa.Array, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of masks of the given rows; a null mask has none."""
    known, counts = masks.is_valid().to_numpy(zero_copy_only=False), masks.flatten()
    if counts.null_count:
        raise ValueError("a run without a length")
    return line.spans(counts.to_numpy(zero_copy_only=False), _numbers(masks)[known], row[known])


def _numbers(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _counts(values: np.ndarray, number: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(number)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()), type=COUNTS)


def _mask(counts, height, width) -> np.ndarray | None:
    return None if counts is None else kernels.decode_rle(counts, height, width)


#: Pixels that are drawn at once, beyond those of one mask.
DRAWN = 1 << 24


def _by_size(values: pa.Array, height: pa.Array, width: pa.Array, more: Sequence[pa.Array], kernel: Callable[..., pa.Array], kind: pa.DataType) -> pa.Array:
    """What ``kernel`` makes of values of one size at once, in the order of the rows. Nulls stay."""
    known = np.flatnonzero(values.is_valid())
    if any(c.take(pa.array(known)).null_count for c in (height, width)):
        raise ValueError("a mask without a size")
    keys = np.array([c.take(pa.array(known)).to_numpy(zero_copy_only=False) for c in (height, width, *more)], np.int64)
    sizes, size = np.unique(keys, axis=1, return_inverse=True)
    order = np.argsort(size.ravel(), kind="stable")
    ends, parts = np.cumsum(np.bincount(size.ravel(), minlength=sizes.shape[1])), [pa.array([], kind)]
    for (high, wide, *rest), group in zip(sizes.T.tolist(), np.split(order, ends[:-1]) if len(known) else [], strict=True):
        step = max(1, DRAWN // max(1, high * wide))
        for at in range(0, len(group), step):
            parts.append(kernel(values.take(pa.array(known[group[at : at + step]])), high, wide, *rest))
    place = np.full(len(values), -1)
    place[known[order]] = np.arange(len(known))
    return pa.concat_arrays(parts).take(pa.array(place, mask=place < 0))


def primary_components(df: DataFrame, counts: str = "counts", height: str = "height", width: str = "width") -> DataFrame:
    """The largest part of each mask (parts bridge gaps of a pixel or two) in place of it, and component_fraction."""

    def kernel(c, h, w):
        if c is None:
            return None, None
        kept, part = kernels.primary_component(_mask(c, h, w))
        return kernels.encode_rle(kept), float(part)

    return by_row(df, [counts, height, width], f"{counts} array<int>, component_fraction double", kernel)


def fused_masks(df: DataFrame, forward: str = "forward_counts", backward: str = "backward_counts", height: str = "height", width: str = "width", least: float = 0.65) -> DataFrame:
    """Adds counts (the largest part of both directions' union, null where it is too small a share), area, box, directional_iou and component_fraction."""

    def kernel(f, b, h, w):
        mask, agreement, part = kernels.fused(_mask(f, h, w), _mask(b, h, w), least)
        if mask is None:
            return None, None, None, float(agreement), float(part)
        return kernels.encode_rle(mask), int(mask.sum()), list(kernels.mask_box(mask)), float(agreement), float(part)

    return by_row(df, [forward, backward, height, width], "counts array<int>, area bigint, box array<bigint>, directional_iou double, component_fraction double", kernel)


def union_masks(df: DataFrame, masks: str = "masks", height: str = "height", width: str = "width") -> DataFrame:
    """Adds counts and area: pixels that any of a row's masks (an array of counts) has. Null and no masks are empty."""

    def kernel(some, h, w):
        line = _line(h, w)
        spans = _spans(line, some.flatten(), np.repeat(np.arange(len(h)), _numbers(some)))
        places = line.places(*spans)
        counts, number, area = line.runs(places, kernels.covered(places, *spans))
        return [_counts(counts, number), pa.array(area, pa.int64())]

    return by_batch(df, [masks, height, width], "counts array<int>, area bigint", kernel)


def combined_masks(df: DataFrame, first: str, second: str, height: str = "height", width: str = "width") -> DataFrame:
    """Adds both (pixels of both masks), either, only_first and neither, as counts. A null mask is empty."""

    def kernel(a, b, h, w):
        line, row = _line(h, w), np.arange(len(h))
        a, b = _spans(line, a, row), _spans(line, b, row)
        places = line.places(*a, *b)
        a, b = kernels.covered(places, *a), kernels.covered(places, *b)
        return [_counts(*line.runs(places, on)[:2]) for on in (a & b, a | b, a & ~b, ~(a | b))]

    return by_batch(df, [first, second, height, width], "both array<int>, either array<int>, only_first array<int>, neither array<int>", kernel)


def packed_masks(df: DataFrame, counts: str = "counts", height: str = "height", width: str = "width") -> DataFrame:
    """Adds packed: the bits of each mask, row by row, each row filled up to whole bytes."""
    def kernel(c, h, w):
        def drawn(some: pa.Array, high: int, wide: int) -> pa.Array:
            line = kernels.Line(np.full(len(some), high), np.full(len(some), wide))
            mask = line.drawn(*_spans(line, some, np.arange(len(some)))).reshape(len(some), wide, high).transpose(0, 2, 1)
            return pa.array([m.tobytes() for m in np.packbits(mask, axis=2)], pa.binary())

        return [_by_size(c, h, w, [], drawn, pa.binary())]

    return by_batch(df, [counts, height, width], "packed binary", kernel)


def unpacked_masks(df: DataFrame, packed: str = "packed", height: str = "height", width: str = "width") -> DataFrame:
    """Adds counts: what ``packed_masks`` packed."""
    def kernel(p, h, w):
        def runs(some: pa.Array, high: int, wide: int, _) -> pa.Array:
            line = kernels.Line(np.full(len(some), high), np.full(len(some), wide))
            data = np.frombuffer(b"".join(some.to_pylist()), np.uint8).reshape(len(some), high, -1)
            pixels = np.unpackbits(data, axis=2, count=wide).transpose(0, 2, 1).ravel().astype(bool)
            places = line.places(np.flatnonzero(pixels[1:] != pixels[:-1]) + 1)
            return _counts(*line.runs(places, pixels[places])[:2])

        return [_by_size(p, h, w, [pc.binary_length(p)], runs, COUNTS)]

    return by_batch(df, [packed, height, width], "counts array<int>", kernel)


def rescaled_masks(df: DataFrame, to_height: str, to_width: str, counts: str = "counts", height: str = "height", width: str = "width") -> DataFrame:
    """Masks brought to another size by nearest neighbours."""

    def kernel(c, h, w, th, tw):
        return (None if c is None else kernels.encode_rle(kernels.nearest(_mask(c, h, w), th, tw)),)

    return by_row(df, [counts, height, width, to_height, to_width], f"{counts} array<int>", kernel)


def smoothed_depth(df: DataFrame, depth: str = "depth", height: str = "height", width: str = "width") -> DataFrame:
    """Edge-preserving smoothing of float32 depth maps (bytes, row by row)."""

    def kernel(data, h, w):
        return (None if data is None else kernels.bilateral(np.frombuffer(data, np.float32).reshape(h, w)).tobytes(),)

    return by_row(df, [depth, height, width], f"{depth} binary", kernel)


def crops(df: DataFrame, backend, counts: str = "counts", square: bool = True) -> DataFrame:
    """Adds crop, crop_height and crop_width: the masked object of each image (content) on white, in a padded square or its padded box."""

    def kernel(content, c):
        if content is None or c is None:
            return None, None, None
        image = backend.decode(content)
        mask = kernels.decode_rle(c, *image.shape[:2])
        out = kernels.square_crop(image, mask) if square else kernels.masked_crop(image, mask)
        return out.tobytes(), out.shape[0], out.shape[1]

    return by_row(df, ["content", counts], "crop binary, crop_height int, crop_width int", kernel)


def overlays(df: DataFrame, backend, masks: str = "masks") -> DataFrame:
    """Adds preview: a PNG of each image (content) with its masks (structs object_id, counts) tinted and outlined by object."""

    def kernel(content, some):
        if content is None:
            return (None,)
        image = backend.decode(content)
        for m in some or ():
            if m["counts"] is not None:
                image = images.overlay(image, kernels.decode_rle(m["counts"], *image.shape[:2]), PALETTE[m["object_id"] % len(PALETTE)])
        return (images.png(image),)

    return by_row(df, ["content", masks], "preview binary", kernel)


# The colours of far and near depth.
FAR_COLOUR, NEAR_COLOUR = (48, 18, 59), (249, 231, 33)


def depth_previews(df: DataFrame, depth: str = "depth", height: str = "height", width: str = "width") -> DataFrame:
    """Adds preview: a PNG of each depth map (float16, row by row) between two colours."""

    def kernel(data, h, w):
        if data is None:
            return (None,)
        return (images.png(images.colourised(np.frombuffer(data, np.float16).reshape(h, w).astype(float), FAR_COLOUR, NEAR_COLOUR)),)

    return by_row(df, [depth, height, width], "preview binary", kernel)


def mesh_previews(df: DataFrame, backend, faces: Sequence[Sequence[int]], colour: tuple[int, int, int] = PALETTE[0]) -> DataFrame:
    """Adds preview: a PNG of each image (content) with a mesh (joints_camera, their points, and faces between them), far faces first."""
    table = np.array(faces)

    def kernel(content, vertices, points):
        if content is None:
            return (None,)
        image = backend.decode(content)
        return (images.png(images.drawn_mesh(image, np.array(vertices, float), np.array(points, float), table, colour) if vertices else image),)

    return by_row(df, ["content", "joints_camera", "points"], "preview binary", kernel)
