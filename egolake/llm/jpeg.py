"""Media columns: progressive JPEG, encoded and decoded in numpy.

The unit of the format is the quantised coefficient, which progressive scans carry without
loss. ``encode`` stores bytes as coefficients of a 4:2:0 image (byte b as 256 + b, in
zigzag order, Y blocks in raster order, then Cb, then Cr). ``decode`` reads any 8-bit
progressive Huffman JPEG: it accumulates spectral-selection and successive-approximation
scans into coefficient arrays. ``rgb`` inverse-transforms them, upsamples chroma and gives
the full-resolution tensor.

Huffman codes are followed one by one, but wherever one symbol is met, the decoder guesses
that it repeats, checks the guess for many places at once, and takes the part that holds.
"""

from __future__ import annotations

import hashlib
import re
import struct
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import column_bytes
from .work import materialize, python_ready

#: Bytes that a payload is a multiple of (nine blocks of 64), macroblocks in a row, rows at most.
UNIT, ROW_MCUS, MAX_ROWS = 576, 16, 4000


def _zigzag() -> np.ndarray:
    """Raster index of each zigzag position."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([8 * r + c for r, c in cells])


ZIGZAG = _zigzag()
_COS = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (np.sqrt(0.125) if u == 0 else 0.5) for x in range(8)] for u in range(8)])
#: Zigzag coefficients to samples: row u of kron is the picture of a coefficient.
_INVERSE = np.kron(_COS, _COS)[ZIGZAG]


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


# Huffman tables of the encoder, as code counts by length and symbols
_DC_SYMBOLS = bytes(range(9))
_AC_SYMBOLS = bytes([0x08, *range(0x00, 0xF0, 0x10)])
_DHT = _segment(0xC4, bytes([0x00, 0, 0, 0, 9, *[0] * 12]) + _DC_SYMBOLS + bytes([0x10, 1, 0, 0, 0, 15, *[0] * 11]) + _AC_SYMBOLS)
_DQT = _segment(0xDB, bytes([0, *[1] * 64]))


def _sos(parts: list[int], lo: int, hi: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes([len(parts), *(x for c in parts for x in (c + 1, 0x00)), lo, hi, high << 4 | low]))


def _stuffed(bits: np.ndarray) -> bytes:
    """Bits as entropy-coded bytes: ones fill the last byte, and a zero follows each 255."""
    fill = -len(bits) % 8
    return np.packbits(np.concatenate([bits, np.ones(fill, np.uint8)])).tobytes().replace(b"\xff", b"\xff\x00")


def _eob_run(n: int) -> list[tuple[int, int]]:
    """Runs of at most 32767 blocks: (blocks, exponent)."""
    out = []
    while n:
        k = min(n, 0x7FFF)
        out.append((k, k.bit_length() - 1))
        n -= k
    return out


def _bits_of(value: int, n: int) -> list[int]:
    return [value >> i & 1 for i in range(n - 1, -1, -1)]


def padded(payload: bytes) -> bytes:
    """``payload`` with bytes 255 up to a positive multiple of UNIT."""
    return payload + b"\xff" * (-len(payload) % UNIT if payload else UNIT)


def encode(payload: bytes) -> bytes:
    """A progressive JPEG that holds ``payload``; the comment has its length."""
    mcus = max(1, -(-len(payload) // 384))
    least = max(1, -(-mcus // MAX_ROWS))
    wide = max(range(least, max(least, min(mcus, ROW_MCUS)) + 1), key=lambda w: (-(-(-mcus // w) * w), w))  # the widest of those that fill the fewest
    high = -(-mcus // wide)
    mcus = wide * high
    data = np.full(mcus * 384, 255, np.uint8)
    data[: len(payload)] = np.frombuffer(payload, np.uint8)
    block = data.reshape(6 * mcus, 64)
    part = [block[: 4 * mcus], block[4 * mcus : 5 * mcus], block[5 * mcus :]]
    # the order of an interleaved scan: four Y blocks, Cb, Cr
    y = np.arange(4 * mcus).reshape(high, 2, wide, 2).transpose(0, 2, 1, 3).reshape(mcus, 4)
    order = np.concatenate([y, 4 * mcus + np.arange(mcus)[:, None], 5 * mcus + np.arange(mcus)[:, None]], axis=1).ravel()
    half = (block[:, 0].astype(np.int32) + 256) >> 1
    diff = np.concatenate([np.diff(half[: 4 * mcus][y.ravel()], prepend=0)[:, None].reshape(mcus, 4), np.diff(half[4 * mcus : 5 * mcus], prepend=0)[:, None], np.diff(half[5 * mcus :], prepend=0)[:, None]], axis=1).ravel()
    size = np.ceil(np.log2(np.abs(diff) + 1)).astype(np.int64)
    code = (size << size) | (np.where(diff < 0, diff + (1 << size) - 1, diff))  # a code of four bits is the size itself
    n = size + 4
    at = np.concatenate([[0], np.cumsum(n)])
    i = np.arange(at[-1])
    token = np.repeat(np.arange(len(n)), n)
    dc = (code[token] >> (at[token + 1] - 1 - i) & 1).astype(np.uint8)

    def first(c: int, lo: int, hi: int) -> bytes:
        v = ((part[c][:, lo : hi + 1].astype(np.uint16) + 256) >> 1).astype(np.uint8).ravel()
        bits = np.zeros((len(v), 9), np.uint8)
        bits[:, 1:] = np.unpackbits(v).reshape(-1, 8)
        return _sos([c], lo, hi, 0, 1) + _stuffed(bits.ravel())

    def refine(c: int) -> bytes:
        low, out, b = part[c][:, 1:] & 1, [], 0
        for k, e in _eob_run(len(low)):
            out += [np.array(_bits_of(16 + e, 5) + _bits_of(k - (1 << e), e), np.uint8), low[b : b + k].ravel()]
            b += k
        return _sos([c], 1, 63, 1, 0) + _stuffed(np.concatenate(out))

    frame = struct.pack(">BHHB", 8, 16 * high, 16 * wide, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    return b"".join([
        b"\xff\xd8", _segment(0xFE, b"payload %d" % len(payload)), _DQT, _segment(0xC2, frame), _DHT,
        _sos([0, 1, 2], 0, 0, 0, 1), _stuffed(dc),
        first(0, 1, 5), first(1, 1, 63), first(2, 1, 63), first(0, 6, 63),
        _sos([0, 1, 2], 0, 0, 1, 0), _stuffed(block[order, 0] & 1),
        refine(0), refine(1), refine(2), b"\xff\xd9",
    ])


# decoding ------------------------------------------------------------------


class Part(NamedTuple):
    """A component: sampling factors, quantisation, blocks in the padded grid and in the image, coefficients."""

    h: int
    v: int
    table: int
    across: int
    down: int
    shown_across: int
    shown_down: int
    coefs: np.ndarray


class Image(NamedTuple):
    width: int
    height: int
    parts: list[Part]
    tables: dict[int, np.ndarray]
    comment: bytes


_lookups: dict[bytes, tuple[np.ndarray, list[int]]] = {}


def _lookup(body: bytes) -> tuple[np.ndarray, list[int]]:
    """For the next 16 bits: length * 256 + symbol of the code they start with, 0 if none."""
    got = _lookups.get(body)
    if got is None:
        table, code, k = np.zeros(1 << 16, np.int32), 0, 16
        for length in range(1, 17):
            for _ in range(body[length - 1]):
                a = code << (16 - length)
                table[a : a + (1 << (16 - length))] = length << 8 | body[k]
                code, k = code + 1, k + 1
            code <<= 1
        if len(_lookups) > 64:
            _lookups.clear()
        _lookups[body] = got = table, table.tolist()
    return got


class _Bits:
    """A segment of entropy-coded data."""

    def __init__(self, data: bytes):
        self.data = data.replace(b"\xff\x00", b"\xff") + b"\xff" * 8
        self.size = 8 * (len(self.data) - 8)
        self.at = 0

    def windows(self) -> np.ndarray:
        """32 bits from every byte."""
        a = np.frombuffer(self.data, np.uint8).astype(np.uint32)
        return a[:-3] << 24 | a[1:-2] << 16 | a[2:-1] << 8 | a[3:]

    def peek(self, n: int = 16) -> int:
        if self.at > self.size:
            raise ValueError("entropy-coded data ends too soon")
        lo = self.at >> 3
        return int.from_bytes(self.data[lo : lo + 4]) >> (32 - (self.at & 7) - n) & ((1 << n) - 1)

    def take(self, n: int) -> int:
        if n == 0:
            return 0
        v = self.peek(n)
        self.at += n
        return v

    def symbol(self, table: list[int]) -> int:
        e = table[self.peek()]
        if not e:
            raise ValueError("no such Huffman code")
        self.at += e >> 8
        return e & 255

    def many(self, n: int) -> np.ndarray:
        """The next n bits."""
        if self.at + n > self.size:
            raise ValueError("entropy-coded data ends too soon")
        lo = self.at >> 3
        raw = np.frombuffer(self.data, np.uint8, ((self.at + n + 7) >> 3) - lo, lo)
        out = np.unpackbits(raw)[self.at & 7 :][:n]
        self.at += n
        return out


def _dc_first(bits: _Bits, order: list[tuple[int, np.ndarray]], tables, low: int, parts: list[Part], sequence: list[int]) -> None:
    """sequence: component of each block in turn."""
    window, at, value = bits.windows().tolist(), bits.at, [0] * len(order)
    look = [tables[i] for i in range(len(order))]
    got: list[list[int]] = [[] for _ in order]
    for c in sequence:
        e = look[c][window[at >> 3] >> (16 - (at & 7)) & 0xFFFF]
        at += e >> 8
        s = e & 255
        if s:
            v = window[at >> 3] >> (32 - (at & 7) - s) & ((1 << s) - 1)
            at += s
            value[c] += v if v >> (s - 1) else v - (1 << s) + 1
        elif not e:
            raise ValueError("no such Huffman code")
        got[c].append(value[c])
    if at > bits.size:
        raise ValueError("entropy-coded data ends too soon")
    for (c, where), v in zip(order, got, strict=True):
        parts[c].coefs[where, 0] = np.array(v, np.int32) << low


def _ac_first(bits: _Bits, blocks, count: int, lo: int, hi: int, low: int, table, coefs: np.ndarray) -> None:
    band = hi - lo + 1
    flat = np.zeros(count * band, np.int32)
    window = bits.windows()
    look, codes = table
    at, end, guess = 0, len(flat), 4096
    while at < end:
        start = bits.at
        s = bits.symbol(codes)
        r, s = s >> 4, s & 15
        if s:
            v = bits.take(s)
            step, k = bits.at - start, at + r
            if k >= end or k // band != at // band:
                raise ValueError("a run leaves its block")
            flat[k] = v if v >> (s - 1) else v - (1 << s) + 1
            at = k + 1
            if r == 0 and guess > 1:
                n = max(0, min(guess, end - at, (bits.size - bits.at) // step))
                q = bits.at + step * np.arange(n)
                w, shift = window[q >> 3], (q & 7).astype(np.uint32)
                same = look[w >> (16 - shift) & 0xFFFF] == (step - s) << 8 | s
                n_same = n if same.all() else int(same.argmin())
                size = np.uint32(step - s)
                if step <= 24:
                    x = (w[:n_same] >> (32 - shift[:n_same] - step) & ((1 << s) - 1)).astype(np.int32)
                else:
                    q = q[:n_same] + size
                    x = (window[q >> 3] >> (32 - (q & 7).astype(np.uint32) - s) & ((1 << s) - 1)).astype(np.int32)
                flat[at : at + n_same] = np.where(x >> (s - 1), x, x - (1 << s) + 1)
                at += n_same
                bits.at += step * n_same
                guess = min(guess * 8, 1 << 18) if n_same == n else 8 if n_same >= 4 else max(1, guess // 16)
            elif guess <= 1:
                guess = 2 if r == 0 else 1
        elif r == 15:
            if (at + 16) // band != at // band and (at + 16) % band:
                raise ValueError("a run leaves its block")
            at += 16
        else:
            run = (1 << r) + bits.take(r)
            at = (at // band + run) * band
    if at > end:
        raise ValueError("a run of ends leaves the scan")
    coefs[blocks, lo : hi + 1] = flat.reshape(-1, band) << low


def _ac_refine(bits: _Bits, blocks, count: int, lo: int, hi: int, low: int, table, coefs: np.ndarray) -> None:
    c = coefs[blocks, lo : hi + 1]
    band, one, b, k = hi - lo + 1, 1 << low, 0, 0
    codes = table[1]

    def correct(view: np.ndarray) -> None:
        """One bit for each non-zero coefficient."""
        nz = view != 0
        if nz.all():
            view += np.sign(view) * (bits.many(view.size).reshape(view.shape).astype(np.int32) << low)
        else:
            old = view[nz]
            view[nz] = old + np.sign(old) * (bits.many(len(old)).astype(np.int32) << low)

    while b < len(c):
        s = bits.symbol(codes)
        r, s = s >> 4, s & 15
        if s == 0 and r < 15:
            run = (1 << r) + bits.take(r)
            if b + run > len(c):
                raise ValueError("a run of ends leaves the scan")
            correct(c[b, k:])
            if run > 1:
                correct(c[b + 1 : b + run])
            b, k = b + run, 0
            continue
        new = 0
        if s:
            new = one if bits.take(1) else -one
        row = c[b]
        while k < band:
            if row[k]:
                if bits.take(1):
                    row[k] += one if row[k] > 0 else -one
            elif r == 0:
                break
            else:
                r -= 1
            k += 1
        if k >= band and (new or r):
            raise ValueError("a run leaves its block")
        if new:
            row[k] = new
        k += 1
        if k >= band:
            b, k = b + 1, 0
    coefs[blocks, lo : hi + 1] = c


_END = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")
_RESTART = re.compile(rb"\xff[\xd0-\xd7]")


def decode(data: bytes) -> Image:
    """The coefficients of a progressive JPEG, all its scans accumulated."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at, comment, quant, huff, parts, ids, restart = 2, b"", {}, {}, [], {}, 0
    width = height = h_max = v_max = 0
    while True:
        if data[at] != 0xFF:
            raise ValueError("a marker is missing")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0xD9:
            return Image(width, height, parts, quant, comment)
        n = data[at + 2] << 8 | data[at + 3]
        body = data[at + 4 : at + 2 + n]
        at += 2 + n
        if marker == 0xFE:
            comment = body
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = np.frombuffer(body, ">u2" if wide else "u1", 64, 1).astype(np.int32)
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                k = 17 + sum(body[1:17])
                huff[body[0]] = _lookup(bytes(body[1:k]))
                body = body[k:]
        elif marker == 0xDD:
            restart = body[0] << 8 | body[1]
        elif marker == 0xC2:
            bits, height, width, count = struct.unpack(">BHHB", body[:6])
            if bits != 8 or not width or not height:
                raise ValueError("only 8-bit images of known size are read")
            spec = [body[6 + 3 * i : 9 + 3 * i] for i in range(count)]
            h_max, v_max = max(s[1] >> 4 for s in spec), max(s[1] & 15 for s in spec)
            across, down = -(-width // (8 * h_max)), -(-height // (8 * v_max))
            for i, (name, hv, table) in enumerate(spec):
                h, v = hv >> 4, hv & 15
                ids[name] = i
                shown = -(-(-(-width * h // h_max)) // 8), -(-(-(-height * v // v_max)) // 8)
                parts.append(Part(h, v, table, across * h, down * v, *shown, np.zeros((across * h * down * v, 64), np.int32)))
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("only progressive Huffman JPEGs are read")
        elif marker == 0xDA:
            end = _END.search(data, at)
            if end is None:
                raise ValueError("the image does not end")
            used = [(ids[body[1 + 2 * i]], body[2 + 2 * i]) for i in range(body[0])]
            lo, hi, shift = body[1 + 2 * body[0] :][:3]
            _scan(_RESTART.split(data[at : end.start()]), used, lo, hi, shift >> 4, shift & 15, parts, huff, restart, h_max, v_max)
            at = end.start()


def _scan(pieces, used, lo, hi, high, low, parts, huff, restart, h_max, v_max) -> None:
    if len(used) == 1:  # the blocks of the image, not those that fill up macroblocks
        p = parts[used[0][0]]
        blocks = (np.arange(p.shown_down)[:, None] * p.across + np.arange(p.shown_across)).reshape(-1, 1)
        units = [(used[0][0], blocks)]
    else:
        units = []
        for c, _ in used:
            p = parts[c]
            grid = np.arange(p.across * p.down).reshape(p.down // p.v, p.v, p.across // p.h, p.h)
            units.append((c, grid.transpose(0, 2, 1, 3).reshape(-1, p.v * p.h)))
    total = len(units[0][1])
    step = restart or total
    if len(pieces) < -(-total // step):
        raise ValueError("a restart marker is missing")
    for i, data in zip(range(0, total, step), pieces, strict=False):
        mine = [(c, u[i : i + step]) for c, u in units]
        bits, n = _Bits(data), len(mine[0][1])
        if lo == 0 and high == 0:
            sequence = [k for k, (_, u) in enumerate(mine) for _ in range(u.shape[1])] * n
            _dc_first(bits, [(c, u.ravel()) for c, u in mine], [huff[t >> 4][1] for _, t in used], low, parts, sequence)
        elif lo == 0:
            bit, at = bits.many(n * sum(u.shape[1] for _, u in mine)).reshape(n, -1).astype(np.int32) << low, 0
            for c, u in mine:
                parts[c].coefs[u.ravel(), 0] |= bit[:, at : at + u.shape[1]].ravel()
                at += u.shape[1]
        else:
            c, u = mine[0]
            whole = n == len(parts[c].coefs)
            run = _ac_first if high == 0 else _ac_refine
            run(bits, slice(None) if whole else u.ravel(), n, lo, hi, low, huff[16 | used[0][1] & 15], parts[c].coefs)


def payload(image: Image) -> bytes:
    """The bytes that ``encode`` stored; raises for other images."""
    n = int(image.comment.removeprefix(b"payload "))
    value = np.concatenate([p.coefs.ravel() for p in image.parts]) - 256
    if value.min() < 0 or value.max() > 255:
        raise ValueError("not a stored payload")
    return value.astype(np.uint8).tobytes()[:n]


def rgb(image: Image) -> np.ndarray:
    """The full-resolution tensor, height x width x 3 (one component: grey in all three)."""
    h_max, v_max = max(p.h for p in image.parts), max(p.v for p in image.parts)
    planes = []
    for p in image.parts:
        sample = (p.coefs * image.tables[p.table]).astype(np.float64) @ _INVERSE
        plane = np.clip(np.rint(sample) + 128, 0, 255).reshape(p.down, p.across, 8, 8).transpose(0, 2, 1, 3).reshape(8 * p.down, 8 * p.across)
        plane = plane.repeat(v_max // p.v, axis=0).repeat(h_max // p.h, axis=1)
        planes.append(plane[: image.height, : image.width].astype(np.float32))
    if len(planes) == 1:
        return np.stack([planes[0]] * 3, axis=-1).astype(np.uint8)
    y, cb, cr = planes[0], planes[1] - np.float32(128), planes[2] - np.float32(128)
    out = np.empty((*y.shape, 3), np.uint8)
    for i, v in enumerate((y + np.float32(1.402) * cr, y - np.float32(0.344136) * cb - np.float32(0.714136) * cr, y + np.float32(1.772) * cb)):
        out[..., i] = np.clip(np.rint(v), 0, 255)
    return out


# columns -------------------------------------------------------------------


def media_column(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media: every text (null: empty) padded and stored as a JPEG."""
    python_ready(docs.sparkSession)

    def run(batches):
        for b in batches:
            raw, offs = column_bytes(b.column(1))
            media = [encode(padded(raw[x:y].tobytes())) for x, y in zip(offs[:-1], offs[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offs)), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def tensors(media: DataFrame) -> DataFrame:
    """The rows of ``media`` with height, width and rgb (bytes, row by row) of each image.

    Null media give nulls; other columns are kept.
    """
    python_ready(media.sparkSession)
    kept = [c for c in media.columns if c not in ("height", "width", "rgb")]
    at = kept.index("media")

    def run(batches):
        for b in batches:
            got = [None if m is None else rgb(decode(m)) for m in b.column(at).to_pylist()]
            side = [pa.array([None if g is None else g.shape[k] for g in got], pa.int32()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *side, pa.array([None if g is None else g.tobytes() for g in got], pa.binary())], names=[*kept, "height", "width", "rgb"])

    schema = [f"`{c}` {t}" for c, t in media.select(*kept).dtypes] + ["height int", "width int", "rgb binary"]
    return media.select(*kept).mapInArrow(run, ", ".join(schema))


def digest(docs: DataFrame) -> DataFrame:
    """What is read back from the media column of ``docs``, and a feature of its tensor.

    The column is written as a table into the shared folder, and digested from there.
    The feature is height x width, the mean of each channel, and a hash of the RGB tensor.
    Null and empty texts are one unit of bytes 255. Rows that repeat are separate rows.
    """
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for m in b.column(2).to_pylist():
                image = decode(m)
                p, t = payload(image), rgb(image)
                mean = t.reshape(-1, 3).mean(axis=0)
                feature = f"{t.shape[0]}x{t.shape[1]}:{mean[0]:.3f},{mean[1]:.3f},{mean[2]:.3f}:{hashlib.sha256(t).hexdigest()[:16]}"
                for c, v in zip(out, (len(p), hashlib.sha256(p).hexdigest(), crc32(p[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(out, kinds[2:], strict=True))], names=names)

    stored = materialize(media_column(docs), "media", "zstd")
    return stored.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
