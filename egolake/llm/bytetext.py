"""Byte-level text kernels over Arrow string buffers, vectorised with numpy.

Words are ``[^\\x20\\x09-\\x0D]+``. The separators are single ASCII bytes, which never
occur inside a UTF-8 sequence, so words are found on the bytes. A word, a line or a run
of words is identified by a 64-bit hash: a polynomial over the bytes (or word hashes)
modulo 2**64, taken from prefix sums, and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of text that are handled at once; a longer document is a chunk of its own.
CHUNK_BYTES = 1 << 19

_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=U)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def powers(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        step = np.full(max(n, 2 * len(have), 1 << 16), _BASE if kind == "up" else _INVERSE, U)
        step[0] = 1
        _powers[kind] = have = np.multiply.accumulate(step)
    return have[:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """P with P[j]-P[i] the polynomial of values[i:j] times BASE**i."""
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers("up", len(values)), out=out[1:])
    return out


def spans_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of every values[start:end], the length included."""
    body = (prefix[end] - prefix[start]) * powers("down", len(prefix))[start]
    return mix(body + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n+1 offsets of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(column, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about ``limit`` bytes: first row, last row + 1, bytes, offsets."""
    raw, offs = column_bytes(column)
    at, n = 0, len(offs) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, to, raw[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


def word_spans(raw: np.ndarray, offs: np.ndarray, outside: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each row's first word (n+1 values).

    ``outside`` marks the bytes that no word has.
    """
    inside = ~outside[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offs[(offs > 0) & (offs < len(raw))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offs)


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return spans_hash(prefix_sums(_BYTE[raw]), start, end)


def gram_starts(bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word indexes at which k words of one row start, and each row's range among them (n+1 values)."""
    n = np.maximum(np.diff(bounds) - k + 1, 0)
    to = np.concatenate([[0], np.cumsum(n)])
    return np.arange(to[-1]) + np.repeat(bounds[:-1] - to[:-1], n), to
