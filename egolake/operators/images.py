"""Image kernels in numpy: resizing, warping, edges, optical flow, drawing and PNG files.

Images are height x width arrays (grey, floats or bytes) or height x width x 3 (RGB bytes).
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np

LUMA = np.array([0.299, 0.587, 0.114])


def grey(image: np.ndarray) -> np.ndarray:
    return image.astype(np.float64) @ LUMA if image.ndim == 3 else image.astype(np.float64)


@lru_cache(maxsize=64)
def _weights(size: int, to: int, area: bool) -> np.ndarray:
    """Rows of weights that make ``to`` samples of ``size``: by covered area, or linear between centres."""
    out = np.zeros((to, size))
    step = size / to
    if area and step > 1:
        edge = np.arange(to + 1) * step
        for i in range(to):
            a, b = edge[i], min(edge[i + 1], size)
            at = np.arange(int(a), min(int(np.ceil(b)), size))
            out[i, at] = np.minimum(at + 1, b) - np.maximum(at, a)
        return out / out.sum(1, keepdims=True)
    centre = np.clip((np.arange(to) + 0.5) * step - 0.5, 0, size - 1)
    low = np.minimum(centre.astype(int), max(size - 2, 0))
    part = centre - low
    out[np.arange(to), low] += 1 - part
    if size > 1:
        out[np.arange(to), low + 1] += part
    return out


def resized(image: np.ndarray, height: int, width: int, area: bool = True) -> np.ndarray:
    """``area`` averages what a pixel covers where the image shrinks; otherwise linear."""
    return _weights(image.shape[0], height, area) @ image.astype(np.float64) @ _weights(image.shape[1], width, area).T


def nearest(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Nearest neighbours."""
    ys, xs = np.arange(height) * image.shape[0] // height, np.arange(width) * image.shape[1] // width
    return image[np.ix_(ys, xs)]


def warped(image: np.ndarray, x: np.ndarray, y: np.ndarray, outside: float) -> np.ndarray:
    """Linear samples at (x, y); neighbours beyond the border count as ``outside``."""
    h, w = image.shape
    wide = np.pad(image.astype(np.float64), 1, constant_values=outside)
    x, y = np.clip(x, -1, w) + 1, np.clip(y, -1, h) + 1
    x0, y0 = np.minimum(x.astype(int), w), np.minimum(y.astype(int), h)
    dx, dy = x - x0, y - y0
    out = np.zeros(x.shape)
    for value, weight in ((wide[y0, x0], (1 - dx) * (1 - dy)), (wide[y0, x0 + 1], dx * (1 - dy)), (wide[y0 + 1, x0], (1 - dx) * dy), (wide[y0 + 1, x0 + 1], dx * dy)):
        out += np.where(weight == 0, 0.0, value * weight)
    return out


def sobel(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Horizontal and vertical derivatives with 3 x 3 Sobel weights; borders are mirrored."""
    p = np.pad(image.astype(np.float64), 1, mode="reflect" if min(image.shape) > 1 else "edge")
    rows, cols = p[:-2] + 2 * p[1:-1] + p[2:], p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    return rows[:, 2:] - rows[:, :-2], cols[2:] - cols[:-2]


def grown(mask: np.ndarray, side: int) -> np.ndarray:
    """The mask dilated by a square of an odd ``side``."""
    out = mask.astype(bool)
    for axis in (0, 1):
        near = out.copy()
        for k in range(1, side // 2 + 1):
            to, back = [slice(None)] * 2, [slice(None)] * 2
            to[axis], back[axis] = slice(k, None), slice(None, -k)
            near[tuple(to)] |= out[tuple(back)]
            near[tuple(back)] |= out[tuple(to)]
        out = near
    return out


def edges(image: np.ndarray, low: float, high: float) -> np.ndarray:
    """Edges of a grey image: ridges of the gradient above ``low`` that connect to one above ``high``."""
    gx, gy = sobel(np.rint(image))
    size = np.abs(gx) + np.abs(gy)
    wide = np.pad(size, 1)
    steep = np.abs(gy) > 2.414213562 * np.abs(gx)
    flat = np.abs(gy) < 0.414213562 * np.abs(gx)
    at = lambda dy, dx: wide[1 + dy : 1 + dy + size.shape[0], 1 + dx : 1 + dx + size.shape[1]]
    rising = (gx * gy) > 0
    before = np.where(flat, at(0, -1), np.where(steep, at(-1, 0), np.where(rising, at(-1, -1), at(-1, 1))))
    after = np.where(flat, at(0, 1), np.where(steep, at(1, 0), np.where(rising, at(1, 1), at(1, -1))))
    weak = (size > low) & (size > before) & (size >= after)
    found = weak & (size > high)
    while True:
        more = grown(found, 3) & weak
        if (more == found).all():
            return found
        found = more


def _box(image: np.ndarray, reach: int) -> np.ndarray:
    """Means over squares that reach so far on each side."""
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (reach + 1, reach)
        total = np.cumsum(np.pad(image, pad, mode="edge"), axis=axis)
        n = total.shape[axis]
        image = (np.take(total, range(2 * reach + 1, n), axis) - np.take(total, range(n - 2 * reach - 1), axis)) / (2 * reach + 1)
    return image


def optical_flow(first: np.ndarray, second: np.ndarray, levels: int = 3, reach: int = 7, rounds: int = 4) -> np.ndarray:
    """Where each pixel of ``first`` is in ``second``: height x width x (dx, dy).

    Dense least squares over a window (Lucas and Kanade), from coarse to fine.
    """
    pyramid = [(first.astype(np.float64), second.astype(np.float64))]
    while len(pyramid) < levels and min(pyramid[-1][0].shape) >= 4 * reach:
        h, w = pyramid[-1][0].shape
        pyramid.append(tuple(resized(p, h // 2, w // 2) for p in pyramid[-1]))
    flow = np.zeros((*pyramid[-1][0].shape, 2))
    for a, b in reversed(pyramid):
        h, w = a.shape
        if flow.shape[:2] != (h, w):
            scale = (w / flow.shape[1], h / flow.shape[0])
            flow = np.stack([resized(flow[..., k], h, w, False) * scale[k] for k in (0, 1)], -1)
        gx, gy = (g / 8 for g in sobel(a))
        xx, yy, xy = _box(gx * gx, reach) + 0.1, _box(gy * gy, reach) + 0.1, _box(gx * gy, reach)
        det = xx * yy - xy * xy
        x, y = np.meshgrid(np.arange(w, dtype=float), np.arange(h, dtype=float))
        for _ in range(rounds):
            there = warped(np.pad(b, 1, mode="edge"), np.clip(x + flow[..., 0], 0, w - 1) + 1, np.clip(y + flow[..., 1], 0, h - 1) + 1, 0.0)
            t = there - a
            tx, ty = _box(gx * t, reach), _box(gy * t, reach)
            flow = flow - np.stack([(yy * tx - xy * ty) / det, (xx * ty - xy * tx) / det], -1)
    return flow


# drawing -------------------------------------------------------------------


def png(image: np.ndarray) -> bytes:
    """An RGB or grey byte image as a PNG file."""
    h, w = image.shape[:2]
    rows = np.concatenate([np.zeros((h, 1), np.uint8), image.reshape(h, -1).astype(np.uint8)], axis=1)
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    head = struct.pack(">IIBBBBB", w, h, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def overlay(image: np.ndarray, mask: np.ndarray, colour: tuple[int, int, int], alpha: float = 0.45, line: int = 2) -> np.ndarray:
    """The image with a mask tinted and its outline drawn."""
    out = image.astype(np.float64)
    out[mask] = (1 - alpha) * out[mask] + alpha * np.array(colour)
    inner = ~grown(~np.pad(mask, 1), 2 * line - 1)[1:-1, 1:-1] if line else mask
    out[mask & ~inner] = colour
    return np.rint(out).astype(np.uint8)


def colourised(depth: np.ndarray, low: tuple[int, int, int], high: tuple[int, int, int]) -> np.ndarray:
    """Values 0 to 1 between two colours."""
    v = np.clip(np.nan_to_num(depth), 0, 1)[..., None]
    return np.rint((1 - v) * np.array(low) + v * np.array(high)).astype(np.uint8)


def contact_sheet(images: list[np.ndarray], columns: int, side: int) -> np.ndarray:
    """Thumbnails in a grid, each within a square of ``side`` on white."""
    if not images:
        return np.full((side, side, 3), 255, np.uint8)
    rows = -(-len(images) // columns)
    out = np.full((rows * side, min(columns, len(images)) * side, 3), 255, np.uint8)
    for i, image in enumerate(images):
        scale = min(1.0, side / max(image.shape[:2]))
        h, w = (max(1, round(s * scale)) for s in image.shape[:2])
        small = np.stack([resized(image[..., k], h, w) for k in range(3)], -1)
        y, x = i // columns * side, i % columns * side
        out[y : y + h, x : x + w] = np.rint(small)
    return out


def painters_order(vertices: np.ndarray, faces: np.ndarray) -> np.ndarray:
    """Faces from the farthest to the nearest by their mean depth (z); of equals in their order."""
    return np.argsort(-vertices[faces][..., 2].mean(1), kind="stable")


def drawn_mesh(image: np.ndarray, vertices: np.ndarray, points: np.ndarray, faces: np.ndarray, colour: tuple[int, int, int], alpha: float = 0.6) -> np.ndarray:
    """A mesh (camera vertices, their pixels, faces) over the image, near faces over far ones, shaded by slope."""
    out = image.astype(np.float64)
    h, w = image.shape[:2]
    for f in painters_order(vertices, faces):
        p = points[faces[f]]
        if not np.isfinite(p).all():
            continue
        x0, y0 = np.maximum(np.floor(p.min(0)).astype(int), 0)
        x1, y1 = np.minimum(np.ceil(p.max(0)).astype(int) + 1, [w, h])
        area = (p[1, 0] - p[0, 0]) * (p[2, 1] - p[0, 1]) - (p[1, 1] - p[0, 1]) * (p[2, 0] - p[0, 0])
        if x1 <= x0 or y1 <= y0 or area == 0:
            continue
        x, y = np.meshgrid(np.arange(x0, x1) + 0.5, np.arange(y0, y1) + 0.5)
        side = lambda a, b: ((b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0])) / area  # noqa: B023, E731
        inside = (side(p[0], p[1]) >= 0) & (side(p[1], p[2]) >= 0) & (side(p[2], p[0]) >= 0)
        normal = np.cross(vertices[faces[f][1]] - vertices[faces[f][0]], vertices[faces[f][2]] - vertices[faces[f][0]])
        shade = 0.35 + 0.65 * abs(normal[2]) / max(np.linalg.norm(normal), 1e-12)
        part = out[y0:y1, x0:x1]
        part[inside] = (1 - alpha) * part[inside] + alpha * shade * np.array(colour)
    return np.rint(out).astype(np.uint8)
