"""SentencePiece encoding that keeps the source span of every piece, and decoding.

A text is normalised by the longest prefix in the model's compiled character map, and every
normalised character keeps the source byte it came from. Pieces are then formed by merges of
best score, and each piece is projected to its span of original UTF-8 bytes. Merges never
cross a point where a word sign follows another character unless a piece of the model does,
so texts are merged word by word: the different words of many texts at once, one merge of each
a round. The map is walked from every byte of every text; texts in which it finds something
are normalised prefix by prefix, in the others every character stands for itself.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import mix, prefix_sums, spans_hash
from .work import python_ready

SIGN = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Characters of text that are encoded at once; longer texts are cut between words.
ENCODE_CHARS = 1 << 20
#: Characters of a word that is merged beside others; longer ones are merged by themselves.
ROUND_CHARS = 48
_SIGN = ord(SIGN)
_LEAD = np.array([0, 0, 0xC0, 0xE0, 0xF0])  # first byte of a UTF-8 character, by its length


def _fields(data: bytes):
    """Field numbers and values of a protocol buffer message."""
    i = 0

    def number() -> int:
        nonlocal i
        value = shift = 0
        while True:
            c = data[i]
            i += 1
            value |= (c & 127) << shift
            shift += 7
            if c < 128:
                return value

    while i < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            value = number()
        else:
            n = number() if kind == 2 else {5: 4, 1: 8}[kind]
            value = data[i : i + n]
            i += n
        yield key >> 3, value


class CharacterMap:
    """A compiled map: a double-array trie of source strings, then their replacements."""

    def __init__(self, blob: bytes):
        n = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", n // 4, 4).tolist() if n else []
        self.texts = blob[4 + n :]

    @staticmethod
    def _step(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of data[at:], and what replaces it."""
        if not self.units:
            return None
        found, node = None, self._step(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units) or self.units[node] & 0x800000FF != data[i]:
                break
            unit = self.units[node]
            node ^= self._step(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        n, place = found
        return n, self.texts[place : self.texts.index(b"\0", place)]

    def maps(self, raw: np.ndarray) -> np.ndarray:
        """For every byte: whether a mapped prefix starts there. All walks advance together."""
        found = np.zeros(len(raw), bool)
        if not self.units:
            return found
        units = np.array(self.units, np.int64)
        step = (units >> 10) << ((units & 512) >> 6)
        live = at = np.arange(len(raw))
        node = np.full(len(raw), step[0])
        while len(live):
            node = node ^ raw[at]
            ok = node < len(units)
            ok[ok] = units[node[ok]] & 0x800000FF == raw[at[ok]]
            live, at, node = live[ok], at[ok] + 1, node[ok]
            found[live[(units[node] >> 8 & 1) > 0]] = True
            more = ~found[live] & (at < len(raw))
            node = node ^ step[node]
            live, at, node = live[more], at[more], node[more]
        return found


class PieceModel:
    """A BPE model file, and encoding with it."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.path, self.rank, self.ids, self.byte_ids, self.user = path, {}, {}, {}, []
        self.unknown, trainer, normalizer = 0, {}, {}
        n = 0
        for field, value in _fields(data):
            if field == 1:
                d = dict(_fields(value))
                piece, kind = d[1].decode(), d.get(3, NORMAL)
                score = struct.unpack("<f", d[2])[0] if 2 in d else 0.0
                if kind in (NORMAL, USER, UNUSED):
                    self.ids.setdefault(piece, n)
                    self.rank.setdefault(piece, -score)
                    if kind == USER:
                        self.user.append(piece)
                elif kind == BYTE:
                    self.byte_ids[int(piece[3:-1], 16)] = n
                elif kind == UNKNOWN:
                    self.unknown = n
                if kind == UNUSED:
                    raise ValueError("models with unused pieces are not supported")
                n += 1
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("only BPE models are supported")
        self.byte_fallback = bool(trainer.get(35, 0))
        self.suffix = bool(trainer.get(24, 0))
        self.map = CharacterMap(normalizer.get(2, b""))
        self.dummy, self.squeeze, self.escape = bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1)), bool(normalizer.get(5, 1))
        self.user.sort(key=len, reverse=True)
        self.by_word = not any(re.search(f"[^{SIGN}]{SIGN}", p) for p in self.ids)
        self.together = not self.user and not self.squeeze and self.dummy and self.escape and not self.suffix and self.by_word and self.byte_fallback and SIGN in self.ids
        if self.together:
            self._pairs()

    def _pairs(self) -> None:
        """Symbols (pieces, and characters of pieces), and what each pair of them makes."""
        self.symbol = {p: i for i, p in enumerate(dict.fromkeys([*self.ids, *(c for p in self.ids for c in p)]))}
        names, get = list(self.symbol), self.symbol.get
        keys, makes = [], []
        for p in self.ids:
            for k in range(1, len(p)):
                a, b = get(p[:k]), get(p[k:])
                if a is not None and b is not None:
                    keys.append(a * len(names) + b)
                    makes.append(get(p))
        self.char_symbol = np.full(0x110000, -1, np.int32)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.char_symbol[ord(c)] = i
        self.symbol_rank = np.append([self.rank.get(p, np.inf) for p in names], np.inf)  # the last is for -1
        self.symbol_id = np.append([self.ids.get(p, -1) for p in names], -1).astype(np.int64)
        self.symbol_chars = np.append([len(p) for p in names], 1).astype(np.int64)
        self.byte_id = np.array([self.byte_ids[b] for b in range(256)])
        self.id_text = [str(i) for i in range(1 + max(*self.ids.values(), *self.byte_ids.values()))]
        # pairs in a table of open addresses, an eighth full at most
        self.slot_bits = max(4, (8 * len(keys)).bit_length())
        self.slot_key, self.slot_made = np.full(1 << self.slot_bits, -1, np.int64), np.full(1 << self.slot_bits, -1, np.int32)
        left = np.arange(len(keys))
        keys, makes = np.array(keys, np.int64), np.array(makes, np.int32)
        at = self._slot(keys)
        while len(left):
            free = self.slot_key[at[left]] < 0
            self.slot_key[at[left[free]]] = keys[left[free]]  # of several the last stays
            left = left[self.slot_key[at[left]] != keys[left]]
            at[left] = at[left] + 1 & (1 << self.slot_bits) - 1
        self.slot_made[at] = makes

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    def _made(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The symbol that each pair makes, or -1."""
        key = np.where((a < 0) | (b < 0), -2, a.astype(np.int64) * (len(self.symbol_id) - 1) + b)
        at = self._slot(key)
        have = self.slot_key[at]
        out = np.where(have == key, self.slot_made[at], -1)
        left = np.flatnonzero((have != key) & (have >= 0))
        while len(left):
            at[left] = at[left] + 1 & (1 << self.slot_bits) - 1
            have = self.slot_key[at[left]]
            hit = have == key[left]
            out[left[hit]] = self.slot_made[at[left[hit]]]
            left = left[~hit & (have >= 0)]
        return out

    # normalising -----------------------------------------------------------

    def normalise(self, text: str) -> tuple[str, list[int]]:
        """The normalised text, and for each of its characters and its end the source byte."""
        data = text.encode()
        out: list[str] = []
        source: list[int] = []
        space = SIGN if self.escape else " "
        at, end = 0, len(data)
        user = [u.encode() for u in self.user]

        def prefix(i: int) -> tuple[int, str]:
            for u in user:
                if data.startswith(u, i):
                    return len(u), u.decode()
            got = self.map.longest(data, i)
            if got is not None:
                return got[0], got[1].decode()
            n = 1 + (data[i] >= 0xC0) + (data[i] >= 0xE0) + (data[i] >= 0xF0)
            return n, data[i : i + n].decode()

        if self.squeeze:
            while at < end:
                n, piece = prefix(at)
                if piece != " ":
                    break
                at += n
        if at == end:
            return "", [at]
        if self.dummy and not self.suffix:
            out.append(space)
            source.append(at)
        was_space = self.squeeze
        while at < end:
            n, piece = prefix(at)
            if self.squeeze and was_space:
                piece = piece.lstrip(" ")
            if piece:
                for c in piece:
                    out.append(space if c == " " else c)
                    source.append(at)
                was_space = piece.endswith(" ")
            at += n
            if not self.squeeze:
                was_space = False
        stop = at
        if self.squeeze:
            while out and out[-1] == space:
                out.pop()
                stop = source.pop()
        if self.dummy and self.suffix:
            out.append(space)
            source.append(stop)
        return "".join(out), [*source, stop]

    # merging ---------------------------------------------------------------

    def merge(self, word: str) -> list[str]:
        """Pieces of a normalised word: the adjacent pair of best score first, leftmost of equals."""
        parts = self._symbols(word)
        rank, none = self.rank.get, np.inf
        if len(parts) <= 64:
            ranks = [rank(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
            while ranks:
                best = min(ranks)
                if best == none:
                    break
                i = ranks.index(best)
                parts[i] += parts[i + 1]
                del parts[i + 1], ranks[i]
                if i < len(ranks):
                    ranks[i] = rank(parts[i] + parts[i + 1], none)
                if i:
                    ranks[i - 1] = rank(parts[i - 1] + parts[i], none)
            return parts
        rank = self.rank
        nxt, prv, heap = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)], []

        def offer(i: int) -> None:
            j = nxt[i]
            if j >= 0 and (r := rank.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (r, i, parts[i] + parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = nxt[i]
            if not parts[i] or j < 0 or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, ""
            nxt[i] = nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            if prv[i] >= 0:
                offer(prv[i])
            offer(i)
        return [p for p in parts if p]

    def _symbols(self, word: str) -> list[str]:
        if not self.user:
            return list(word)
        return re.findall("|".join(map(re.escape, self.user)) + "|.", word, re.S)

    def pieces(self, word: str) -> list[tuple[int, int, int, int]]:
        """(id, first character, last character + 1, byte within the character or -1) of each piece."""
        out, at = [], 0
        for p in self.merge(word):
            n = len(p)
            if p in self.ids:
                out.append((self.ids[p], at, at + n, -1))
            elif self.byte_fallback:
                out += [(self.byte_ids[b], at, at + n, j) for j, b in enumerate(p.encode())]
            elif out and out[-1][0] == self.unknown and out[-1][2] == at:
                out[-1] = (self.unknown, out[-1][1], at + n, -1)
            else:
                out.append((self.unknown, at, at + n, -1))
            at += n
        return out

    # encoding --------------------------------------------------------------

    def merge_all(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of words after ``merge`` of each, and the word of each symbol.

        ``sym`` are the symbols of the words' characters (-1: no piece has it), ``word`` the
        words they belong to, in order. A round merges the best pair of every word.
        """
        done: list[tuple[np.ndarray, np.ndarray]] = []
        new = np.full(len(sym), -1, np.int32)  # what a symbol makes with the next one
        if len(sym) > 1:
            new[:-1] = np.where(word[:-1] == word[1:], self._made(sym[:-1], sym[1:]), -1)
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(first, len(sym)))
            r = self.symbol_rank[new]
            best = np.minimum.reduceat(r, first)
            over = best == np.inf
            if over.any():
                gone = np.repeat(over, size)
                done.append((sym[gone], word[gone]))
                live = ~gone
                sym, word, new, r = sym[live], word[live], new[live], r[live]
                size, best = size[~over], best[~over]
                if not len(sym):
                    break
            hit = np.flatnonzero(r == np.repeat(best, size))
            hit = hit[np.concatenate([[True], word[hit[1:]] != word[hit[:-1]]])]
            sym[hit] = new[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            hit = hit - np.arange(len(hit))
            sym, word, new = sym[keep], word[keep], new[keep]
            new[hit[hit + 1 == len(sym)]] = -1
            at = np.concatenate([hit - 1, hit])
            at = at[(at >= 0) & (at + 1 < len(sym))]
            new[at] = np.where(word[at] == word[at + 1], self._made(sym[at], sym[at + 1]), -1)
        sym, word = (np.concatenate([np.zeros(0, np.int64), *(d[k] for d in done)]) for k in (0, 1))
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
        """Ids, starts and ends of their spans in the text's UTF-8 bytes, and the ids as text."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]):
        """``encode`` of each text, in order, about ENCODE_CHARS characters at once."""
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= ENCODE_CHARS):
                size += len(texts[to])
                to += 1
            if size > ENCODE_CHARS:  # one very long text
                got = [self._encode_parts(texts[at])]
            else:
                got = self._encode_many(texts[at:to])
            for ids, starts, ends in got:
                yield ids, starts, ends, ",".join(map(self.id_text.__getitem__, ids.tolist())) if self.together else ",".join(map(str, ids.tolist()))
            at = to

    def _encode_parts(self, text: str):
        """A very long text in parts that begin with a space after another character."""
        if not self.together:
            return self._encode_any(text)
        cuts = [0]
        while len(text) - cuts[-1] > ENCODE_CHARS:
            found = re.compile(f"(?<=[^ {SIGN}]) ").search(text, cuts[-1] + ENCODE_CHARS)
            if not found:
                break
            cuts.append(found.start())
        parts, base = [], 0
        for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True):
            got = self._encode_many([text[a:b]], a == 0)
            if got is None:  # mapped prefixes may reach over a cut
                return self._encode_any(text)
            parts.append((got[0][0], got[0][1] + base, got[0][2] + base))
            base += len(text[a:b].encode())
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _encode_many(self, texts: list[str], begin: bool = True):
        """Ids, starts and ends of each text; of a part that isn't the first, None where the map finds something."""
        whole = np.array([bool(t) and self.together for t in texts])
        if whole.any():
            data = [t.encode() if w else b"" for t, w in zip(texts, whole.tolist(), strict=True)]
            mapped = np.flatnonzero(self.map.maps(np.frombuffer(b"".join(data), np.uint8)))
            if len(mapped):
                of = np.searchsorted(np.cumsum([len(d) for d in data]), mapped, "right")
                whole[of] = False
                if len(texts) == 1 and len(texts[0]) > ENCODE_CHARS // 2:
                    return None if not begin else [self._encode_any(texts[0])]
        some = iter(self._encode_words([t for t, w in zip(texts, whole.tolist(), strict=True) if w], begin))
        return [next(some) if w else self._encode_any(t) for t, w in zip(texts, whole.tolist(), strict=True)]

    def _encode_words(self, texts: list[str], begin: bool):
        """Ids, starts and ends of texts whose characters stand for themselves; ``begin``: a sign comes first."""
        if not texts:
            return
        cps = np.frombuffer("".join(texts).encode("utf-32-le"), np.int32)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        width = 1 + (cps > 0x7F) + (cps > 0x7FF) + (cps > 0xFFFF)
        if begin:
            cps, width = np.insert(cps, first[:-1], 32), np.insert(width, first[:-1], 0)
            first = first + np.arange(len(first))
        stop = np.cumsum(width)  # source bytes
        start = stop - width
        cps = np.where(cps == 32, _SIGN, cps)
        sign = cps == _SIGN
        head = sign.copy()
        head[1:] &= ~sign[:-1]
        head[first[:-1]] = True
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, len(cps)))
        # different words: by a hash, then compared with the first of that hash
        key = spans_hash(prefix_sums(mix(cps.astype(np.uint64))), at, at + size)
        _, some, of = np.unique(key, return_index=True, return_inverse=True)
        inner = np.arange(len(cps)) - np.repeat(at, size)
        like = np.minimum(np.repeat(at[some[of]], size) + inner, len(cps) - 1)
        same = np.logical_and.reduceat(cps == cps[like], at) & (size == size[some[of]])
        if not same.all():
            odd = np.flatnonzero(~same)
            of[odd] = len(some) + np.arange(len(odd))
            some = np.concatenate([some, odd])
        ids, lo, hi, part, bounds = self._tokens(cps, at[some], size[some])
        n = np.diff(bounds)[of]
        total = np.cumsum(n)
        take = np.arange(total[-1]) + np.repeat(bounds[of] - (total - n), n)
        base = np.repeat(at, n)
        j = part[take]
        starts, ends = start[base + lo[take]], stop[base + hi[take] - 1]
        starts = np.where(j < 0, starts, starts + j)
        ends = np.where(j < 0, ends, starts + 1)
        ids = ids[take].astype(np.int32)
        cut = np.concatenate([[0], total])[np.searchsorted(at, first)].tolist()
        zero = np.append(start, stop[-1])[first].tolist()
        for i in range(len(texts)):
            a, b = cut[i], cut[i + 1]
            yield ids[a:b], starts[a:b] - zero[i], ends[a:b] - zero[i]

    def _tokens(self, cps: np.ndarray, at: np.ndarray, size: np.ndarray):
        """Of words at these places: ids, first and last character + 1 in the word, byte or -1, and each word's range."""
        long = np.flatnonzero(size > ROUND_CHARS)
        short = np.flatnonzero(size <= ROUND_CHARS)
        n = size[short]
        place = np.arange(n.sum()) + np.repeat(at[short] - (np.cumsum(n) - n), n)
        sym, word = self.merge_all(self.char_symbol[cps[place]], np.repeat(short, n))
        if len(long):
            more, owner = [], []
            for w in long.tolist():
                got = self.merge("".join(map(chr, cps[at[w] : at[w] + size[w]].tolist())))
                more += [self.symbol.get(p, -1) for p in got]
                owner += [w] * len(got)
            sym, word = np.concatenate([sym, np.array(more, np.int64)]), np.concatenate([word, np.array(owner, np.int64)])
            order = np.argsort(word, kind="stable")
            sym, word = sym[order], word[order]
        hi = np.cumsum(self.symbol_chars[sym])
        hi -= np.repeat(np.cumsum(size) - size, np.bincount(word, minlength=len(size)))
        lo = hi - self.symbol_chars[sym]
        ids = self.symbol_id[sym]
        # characters that are no piece are bytes
        c = cps[at[word] + lo]
        width = np.where(ids < 0, 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF), 1)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(word, width, len(size)).astype(np.int64))])
        if (ids < 0).any():
            j = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            ids, lo, hi, c, width = (np.repeat(x, width) for x in (ids, lo, hi, c, width))
            shift = 6 * (width - 1 - j)
            byte = np.where(width == 1, c, np.where(j == 0, _LEAD[width] | c >> shift, 0x80 | c >> shift & 63))
            part = np.where(ids < 0, j, -1)
            ids = np.where(ids < 0, self.byte_id[byte & 255], ids)
        else:
            part = np.full(len(ids), -1)
        return ids, lo, hi, part, bounds

    def _encode_any(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._project(*self.normalise(text))

    def _project(self, norm: str, source: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of a normalised text, with the source spans of their characters."""
        ids, starts, ends, at = [], [], [], 0
        for word in re.findall(f"{SIGN}*[^{SIGN}]+|{SIGN}+", norm) if self.by_word else [norm] * bool(norm):
            for i, a, b, j in self.pieces(word):
                lo, hi = source[at + a], source[at + b]
                ids.append(i)
                starts.append(lo if j < 0 or hi - lo != len(word[a:b].encode()) else lo + j)
                ends.append(hi if j < 0 or hi - lo != len(word[a:b].encode()) else lo + j + 1)
            at += len(word)
        return np.array(ids, np.int32), np.array(starts, np.int64), np.array(ends, np.int64)


_models: dict[str, PieceModel] = {}
_decoders: dict[str, object] = {}


def model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def decoder(path: str):
    if path not in _decoders:
        import sentencepiece

        _decoders[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _decoders[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """The rows of ``docs`` with ids, starts and ends (arrays) in place of the text.

    ``path`` is a model file that every worker has. Null and empty texts have no pieces. The
    span of piece i is bytes starts[i] to ends[i] of the text in UTF-8. Columns ids, starts
    and ends are replaced, others are kept; rows that repeat are separate rows.
    """
    python_ready(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("ids", "starts", "ends", "text")]

    def run(batches):
        m = model(path)
        for batch in batches:
            got = [g[:3] for g in m.encode_all([t or "" for t in batch.column(len(kept)).to_pylist()])]
            size = pa.array(np.concatenate([[0], np.cumsum([len(g[0]) for g in got])]).astype(np.int32))
            cols = [pa.ListArray.from_arrays(size, pa.array(np.concatenate([g[k] for g in got]).astype(np.int32))) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *cols], names=[*kept, "ids", "starts", "ends"])

    rows = docs.select(*kept, "text")
    schema = [f"`{c}` {t}" for c, t in rows.dtypes[:-1]] + ["ids array<int>", "starts array<int>", "ends array<int>"]
    return rows.mapInArrow(run, ", ".join(schema))


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_bytes (end of the last span)."""
    python_ready(docs.sparkSession)

    def run(batches):
        m, d = model(path), decoder(path)
        for batch in batches:
            n, a, b, end = [], [], [], []
            for ids, _, ends, joined in m.encode_all([t or "" for t in batch.column(1).to_pylist()]):
                n.append(len(ids))
                a.append(hashlib.sha256(joined.encode()).hexdigest())
                b.append(hashlib.sha256(d.decode(ids.tolist()).encode()).hexdigest())
                end.append(int(ends[-1]) if len(ends) else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(end, pa.int64())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long")
