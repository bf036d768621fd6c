"""Secret scan: fixed patterns, and tokens tagged begin, inside or outside by a chain CRF.

The field uses the shape of a token, the words and signs around it and features of the whole
text. It is fitted on invented lines, with secrets of kinds that the patterns lack and with
codes that are none, and on what the patterns find in texts of the corpus. Positions whose emission beats every other label by more than all transitions can win
back are outside in every best path; they cut the chains, and Viterbi decodes what is left,
which gives the same labels as decoding whole texts.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from .bytetext import chunks, lower_ascii, prefix_sums, spans_hash, word_spans, _BYTE
from .sample import learnt
from .work import python_ready

# The base patterns, on UTF-8 bytes, with the least length of what they find.
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "crf")

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
#: Documents of the corpus, by a hash of their ids, that take part in fitting.
FIT_DOCS = 1000
#: Of a text that is fitted on: secrets, and other anchors (tokens with a digit or a key word), by a hash of their places, and tokens on each side of either. Chains that are learnt from are cut to so many tokens.
FIT_SECRETS, FIT_ANCHORS, FIT_NEAR, FIT_CHAIN = 20, 40, 10, 24
#: Invented lines that take part in fitting.
FIT_LINES = 3000
KEYWORDS = b"password passwd secret token api apikey api_key key auth authorization bearer credential credentials pwd private access".split()


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars]] = True
    return t


_LOWER, _UPPER, _DIGIT = (_table("".join(map(chr, range(a, b)))) for a, b in ((97, 123), (65, 91), (48, 58)))
_HEX = _DIGIT | _table("abcdef")
_TOKEN = _LOWER | _UPPER | _DIGIT | _table("+/_-.@")
_TOKEN[128:] = True
_SET, _QUOTE, _VOWEL = _table("=:"), _table("\"'`"), _table("aeiouyAEIOUY")
_VOWEL[128:] = True
_TURN = np.zeros(256, np.uint8)  # lower, upper, digit, other
_TURN[_UPPER], _TURN[_DIGIT], _TURN[~(_LOWER | _UPPER | _DIGIT)] = 1, 2, 3
_KEY_HASH = np.unique(spans_hash(prefix_sums(_BYTE[np.frombuffer(b" ".join(KEYWORDS), np.uint8)]), *word_spans(np.frombuffer(b" ".join(KEYWORDS), np.uint8), np.array([0, len(b" ".join(KEYWORDS))]))[:2]))
N_FEATURES = 38


def base_spans(data: bytes, raw: np.ndarray, offs: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) in bytes of the chunk, for each text, in order."""
    n = len(offs) - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    signs = np.diff(np.concatenate([[0], np.cumsum(_SET[raw])])[offs])
    for i in np.flatnonzero(signs):
        for m in ASSIGN.finditer(data, offs[i], offs[i + 1]):
            if m.end(2) - m.start(2) >= LEAST_ASSIGN:
                out[i].append((m.start(), 0, m.end()))
    if b"AKIA" in data:
        for i in range(n):
            for m in ACCESS.finditer(data, offs[i], offs[i + 1]):
                if m.end() - m.start() >= LEAST_ACCESS:
                    out[i].append((m.start(), 1, m.end()))
    start, end, _ = word_spans(raw, offs, ~_HEX)
    long = end - start >= LEAST_HEX
    for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True):
        out[int(np.searchsorted(offs, a, "right")) - 1].append((a, 2, b))
    return [sorted(x) for x in out]


def token_features(raw: np.ndarray, offs: np.ndarray):
    """Token starts, ends, bounds by text, and the features of each token."""
    start, end, bounds = word_spans(raw, offs, ~_TOKEN)
    n = len(start)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(bounds))
    total = lambda t: np.concatenate([[0], np.cumsum(t, dtype=np.int32)])
    part = lambda c: c[end] - c[start]
    size = end - start
    digit_at = _DIGIT[raw]
    lower, upper, digit = part(total(_LOWER[raw])), part(total(_UPPER[raw])), part(total(digit_at))
    hexes, vowel = part(total(_HEX[raw])), part(total(_VOWEL[raw]))
    turns = np.zeros(len(raw) + 1, np.int32)
    turns[1:-1] = np.cumsum(digit_at[1:] != digit_at[:-1])
    turn = turns[np.maximum(end - 1, 0)] - turns[start] if n else size
    sort = _TURN[raw]
    kinds = np.zeros(len(raw) + 1, np.int32)
    kinds[1:-1] = np.cumsum(sort[1:] != sort[:-1])
    change = kinds[np.maximum(end - 1, 0)] - kinds[start] if n else size
    signs, quotes, at_sign = total(_SET[raw]), total(_QUOTE[raw]), part(total(raw == 64))
    dots, slashes, wide, seps = part(total(raw == 46)), part(total(raw == 47)), part(total(raw >= 128)), part(total((raw == 45) | (raw == 95)))
    before = np.where(np.arange(n) > bounds[:-1][row], np.concatenate([[0], end[:-1]]) if n else end, offs[:-1][row])
    after = np.where(np.arange(n) + 1 < bounds[1:][row], np.concatenate([start[1:], [0]]) if n else start, offs[1:][row])
    sign_before, quote_before = signs[start] > signs[before], quotes[start] > quotes[before]
    sign_after, quote_after = signs[after] > signs[end], quotes[after] > quotes[end]
    key = np.isin(spans_hash(prefix_sums(_BYTE[lower_ascii(raw)]), start, end), _KEY_HASH)
    prev_key, next_key = np.zeros(n, bool), np.zeros(n, bool)
    prev_key[1:], next_key[:-1] = key[:-1] & (row[1:] == row[:-1]), key[1:] & (row[1:] == row[:-1])
    has_digit = digit > 0
    by_row = np.maximum(np.bincount(row, minlength=len(offs) - 1), 1)
    doc_digit = (np.bincount(row, has_digit, len(offs) - 1) / by_row)[row]
    doc_key = (np.bincount(row, key, len(offs) - 1) > 0)[row]
    letters = lower + upper
    mixed = has_digit & (letters > 0)
    f = [
        np.ones(n), size >= 8, size >= 16, size >= 20, size >= 32, mixed & (size >= 8), mixed & (size >= 16), (lower > 0) & (upper > 0) & has_digit,
        (hexes == size) & (size >= 16), (turn >= 4) & (size >= 12), digit == size, letters == size, (digit + dots == size) & (dots > 0), at_sign > 0,
        (vowel * 4 < letters) & (letters > 5), key, prev_key, next_key, sign_before & prev_key, sign_before, quote_before & quote_after, sign_after, doc_digit > 0.1, doc_key,
        (change * 4 > size) & (size >= 12), (change * 5 > size * 2) & (size >= 16), (lower > 0) & (upper > 0) & (change > 5), (size >= 40) & (dots < 3) & (slashes < 3) & (wide == 0), slashes + dots > 2, (size >= 8) & (change >= 3) & (prev_key | sign_before),
        (change * 3 > size) & (size >= 12), (digit >= 2) & (upper >= 2) & (lower >= 2) & (size >= 16), (digit > 0) & (digit * 10 < size) & (size >= 10), (digit * 2 > size) & (hexes < size),
        (digit * 2 > 5 * turn) & (turn > 0), seps >= 3, seps * 8 > size, (upper == 0) & (digit > 0),
    ]
    return start, end, bounds, np.stack([np.asarray(v, np.float32) for v in f], axis=1)


def decode(emit: np.ndarray, bounds: np.ndarray, field: crf.Chain) -> np.ndarray:
    """Labels of all tokens: Viterbi over the stretches that certain outside tokens leave."""
    sway = 2 * (field.move.max() - field.move.min()) + field.first.max() - field.first.min()
    open_ = emit[:, OUTSIDE] - emit[:, 1:].max(axis=1) <= sway
    out = np.zeros(len(emit), np.int64)
    at = np.flatnonzero(open_)
    if not len(at):
        return out
    starts_text, ends_text = np.zeros(len(emit) + 1, bool), np.zeros(len(emit) + 1, bool)
    starts_text[bounds[:-1]] = True
    ends_text[bounds[1:] - 1] = True
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | starts_text[at[1:]]])
    cut = np.concatenate([np.flatnonzero(new), [len(at)]])
    e = emit[at].astype(float)
    head, tail = cut[:-1], cut[1:] - 1
    e[head] += np.where(starts_text[at[head]][:, None], field.first, field.move[OUTSIDE])
    e[tail] += np.where(ends_text[at[tail]][:, None], 0.0, field.move[:, OUTSIDE])
    out[at] = crf.viterbi(e, cut, crf.Chain(field.emit, field.move, np.zeros(3)))
    return out


def tagged_spans(start, end, bounds, label) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of begin tokens with the inside tokens that follow, and their text."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    on = np.flatnonzero(label != OUTSIDE)
    if not len(on):
        return on, on, on
    first = np.concatenate([[True], (on[1:] != on[:-1] + 1) | (label[on[1:]] == BEGIN) | (row[on[1:]] != row[on[:-1]])])
    head = np.flatnonzero(first)
    tail = np.concatenate([head[1:], [len(on)]]) - 1
    return start[on[head]], end[on[tail]], row[on[head]]


def _weak_labels(start, end, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Tokens inside a found value (or of an invented one) are begin, then inside; the key of an assignment isn't."""
    y = np.zeros(len(start), np.int64)
    for a, kind, b in spans:
        t = np.flatnonzero((start < b) & (end > a) if kind == 3 else (start >= a) & (end <= b))
        t = t[1:] if kind == 0 and len(t) > 1 else t
        if len(t):
            y[t] = INSIDE
            y[t[0]] = BEGIN
    return y


def _made_up(n: int = FIT_LINES) -> list[tuple[bytes, list[tuple[int, int, int]]]]:
    """Invented lines with known secrets, and with codes that are none."""
    rng = np.random.default_rng(9)
    low, up, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    pick = lambda s, k: "".join(rng.choice(list(s), k))
    size = lambda a, b: int(rng.integers(a, b))
    word = lambda: pick(low, size(2, 10))
    any_ = lambda *k: pick(low + up + num, size(*k))
    cap = lambda: word().capitalize()
    url = low + up + num + "_-"
    keyed = ["secret=", "password: '", "auth ", "token ", "api key ", "key=", "pwd: ", "credential \"", "private key: ", "access ", "Authorization: Bearer "]
    free = ["", "", "", "use ", "set ", *keyed]
    secret = [
        (lambda: pick("0123456789abcdef", int(rng.choice([32, 40, 64]))), free),
        (lambda: "AKIA" + pick(up + num, 16), free),
        (lambda: any_(20, 44), free),
        (lambda: pick(low, size(2, 5)) + str(rng.choice(list("_-"))) + any_(20, 41), free),
        (lambda: f"{word()}_{word()}_" + any_(20, 33), free),
        (lambda: "eyJ" + pick(url, size(15, 40)) + "." + pick(url, size(30, 90)) + "." + pick(url, 43), free),
        (lambda: pick(low + up + num + "+/", size(36, 64)), free),
        (lambda: pick(up, 1) + pick(low, size(2, 6)) + pick(num, size(2, 5)) + pick(up, size(1, 4)) + pick(low, size(1, 4)), keyed),
        (lambda: any_(10, 20), keyed),
        (lambda: pick(url, size(24, 45)), free),
        (lambda: "\n".join(pick(low + up + num + "+/", 64) for _ in range(size(2, 6))), ["-----BEGIN PRIVATE KEY-----\n"]),
    ]
    plain = [
        (lambda: pick(num, size(6, 20)), free),
        (lambda: f"{word()}.{pick(num, 2)}@mail{pick(num, 1)}.example.com", free),
        (lambda: f"{word()}{pick(num, size(1, 4))}@{word()}.example.org", free),
        (lambda: ".".join(str(size(1, 255)) for _ in range(4)), free),
        (lambda: "+1-" + pick(num, 3) + "-" + pick(num, 4), free),
        (lambda: " ".join(pick(low, size(6, 24)) for _ in range(4)), ["the token ", "", "key "]),
        (lambda: f"https://www.{word()}{pick(num, 1)}.example.com/{word()}-{pick(num, 2)}/{word()}_{pick(num, 1)}.html", [""]),
        (lambda: f"20{pick(num, 2)}-{size(10, 13)}-{size(10, 29)}T{size(10, 24)}:{size(10, 60)}:00Z", [""]),
        (lambda: f"v{size(0, 30)}.{size(0, 30)}.{size(0, 99)}-rc{size(1, 9)}", ["", "version "]),
        (lambda: f"{word()}_{word()}_20{pick(num, 2)}_v{pick(num, 1)}.{pick(low, 3)}", ["", "file "]),
        (lambda: word() + cap() + cap() + cap() + str(rng.choice(["", "2", "Id"])), ["", "call "]),
        (lambda: f"{pick(up, 3)}-20{pick(num, 2)}-{pick(num, 6)}", ["", "order "]),
        (lambda: str(rng.choice(list("-_"))).join([pick(up, size(2, 6)), *(pick(num, size(3, 10)) for _ in range(size(1, 4)))]) + "." + pick(low, 3), ["", "file "]),
        (lambda: str(rng.choice(list("-_"))).join(word() if rng.random() < 0.7 else pick(num, size(1, 5)) for _ in range(size(4, 9))), [""]),
        (lambda: str(rng.choice(list("-_"))).join([pick(up, size(2, 5)), *(pick(num, size(3, 9)) for _ in range(size(1, 4)))]), ["", "no. "]),
        (lambda: "-".join(pick("0123456789abcdef", k) for k in (8, 4, 4, 4, 12)), ["", "id "]),
        (lambda: "".join(word() for _ in range(size(3, 6))).capitalize(), ["", "the "]),
        (lambda: "/".join(word() for _ in range(size(3, 7))), ["", "path "]),
        (lambda: pick("äöüßéèçñ" + low, size(12, 34)), [""]),
    ]
    out = []
    styles = [word, word, lambda: word().capitalize(), lambda: word() + pick(num, size(1, 4)), lambda: word() + str(rng.choice(list(",.;"))), lambda: pick(num, size(1, 6))]
    for i in range(n):
        usual = styles[size(0, len(styles))]  # most words of a line are of one kind
        words = [(usual if rng.random() < 0.7 else styles[size(0, len(styles))])() for _ in range(size(2, 24))]
        at = size(0, len(words) + 1)
        hidden = i % 2 == 0
        make, leads = (secret if hidden else plain)[i // 2 % len(secret if hidden else plain)]
        v, lead = make(), leads[size(0, len(leads))]
        tail = lead[-1] if lead[-1:] in ("'", '"') else str(rng.choice(["", "", ".", ","]))
        text = " ".join([*words[:at], ""]) + lead
        begin = len(text.encode())
        text = " ".join([text + v + tail, *words[at:]])
        out.append((text.encode(), [(begin, 3, begin + len(v.encode()))] if hidden else []))
    return out


def _near(secret: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """The tokens of a text that are learnt from."""

    def some(at: np.ndarray, k: int) -> list[int]:
        mixed = (at.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return at[np.argsort(mixed, kind="stable")[:k]].tolist()

    near = np.zeros(len(secret), bool)
    for t in some(np.flatnonzero(secret), FIT_SECRETS) + some(np.flatnonzero(anchor & ~secret), FIT_ANCHORS):
        near[max(0, t - FIT_NEAR) : t + FIT_NEAR + 1] = True
    near[:FIT_NEAR] = True
    return near


def text_chains(data: bytes, spans: list[tuple[int, int, int]] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of the stretches of a text that are learnt from; its base spans are the secrets unless others are given."""
    raw = np.frombuffer(data, np.uint8)
    offs = np.array([0, len(raw)])
    start, end, _, x = token_features(raw, offs)
    y = _weak_labels(start, end, base_spans(data, raw, offs)[0] if spans is None else spans)
    at = np.flatnonzero(_near(y > 0, (x[:, 5] > 0) | (x[:, 10] > 0) | (x[:, 15] > 0)))
    out = []
    for part in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
        out += [(x[part[k : k + FIT_CHAIN]], y[part[k : k + FIT_CHAIN]]) for k in range(0, len(part), FIT_CHAIN)]
    return out


def learn(rows: list[tuple]) -> crf.Chain:
    """Fit the field on invented lines and on (doc_id, pickled chains) rows."""
    chains = [c for _, part in rows for c in pickle.loads(part)]
    for data, spans in _made_up():
        chains += text_chains(data, spans)
    return crf.fit(chains, 3, N_FEATURES, steps=100, l2=1e-5)


def fitted(docs: DataFrame, limit: int = FIT_DOCS) -> crf.Chain:
    """A field fitted on invented lines and on at most ``limit`` texts with their base spans.

    Chains are made where the texts are, from whole texts: tokens further than FIT_NEAR from
    a secret or an anchor are left out, but for a text's first ones. Of rows that repeat an id
    one takes part.
    """
    python_ready(docs.sparkSession)
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.xxhash64(F.col("doc_id")).alias("h")).orderBy("h", "doc_id").limit(limit).select("doc_id")
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id")

    def chains(batches):
        for b in batches:
            made = [pickle.dumps(text_chains(t.encode())) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(made, pa.binary())], names=["doc_id", "chains"])

    return learnt(rows.mapInArrow(chains, "doc_id long, chains binary").groupBy("doc_id").agg(F.min("chains").alias("chains")), learn)


def spans_of(data: bytes, raw: np.ndarray, offs: np.ndarray, field: crf.Chain) -> list[list[tuple[int, int, int]]]:
    """All spans of each text of a chunk: base ones, and tagged ones that no base span holds."""
    found = base_spans(data, raw, offs)
    start, end, bounds, x = token_features(raw, offs)
    label = decode(x @ field.emit.astype(np.float32), bounds, field)
    more: dict[int, list[tuple[int, int, int]]] = {}
    for a, b, i in zip(*(v.tolist() for v in tagged_spans(start, end, bounds, label)), strict=True):
        more.setdefault(i, []).append((a, 3, b))
    for i, tagged in more.items():
        begins = [s for s, _, _ in found[i]]
        reach = list(accumulate((e for _, _, e in found[i]), max))
        held = lambda a, b: (k := bisect_right(begins, a)) > 0 and reach[k - 1] >= b  # noqa: B023, E731
        found[i] = sorted(found[i] + [t for t in tagged if not held(t[0], t[2])])
    return found


def secrets(docs: DataFrame, field: crf.Chain | None = None) -> DataFrame:
    """The rows of ``docs`` with ``secrets``: array of (kind, start, end) in code points.

    Ordered by start, then kind; the end is exclusive. Null and empty texts have none. Base
    spans may overlap each other and spans of the field ("crf"), which no base span holds. A column
    named secrets is replaced, others are kept; rows that repeat are separate rows.
    """
    return _scan(docs, field, False)


def redacted(docs: DataFrame, mask: str = "[SECRET]", field: crf.Chain | None = None) -> DataFrame:
    """The rows of ``docs`` with every secret (overlapping ones as one) replaced by ``mask``.

    Null texts stay null. n_chars, if there, is counted anew for texts that change.
    """
    out = _scan(docs, field, True, mask)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _scan(docs: DataFrame, field: crf.Chain | None, mask_text: bool, mask: str = "") -> DataFrame:
    python_ready(docs.sparkSession)
    field = field or fitted(docs)
    kept = [c for c in docs.columns if c != "secrets"]
    at_text = kept.index("text")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            spans, texts = [], []
            column = batch.column(at_text)
            for at, to, raw, offs in chunks(column):
                data = raw.tobytes()
                points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                for i, found in enumerate(spans_of(data, raw, offs, field)):
                    zero = points[offs[i]]
                    spans.append([{"kind": KINDS[k], "start": int(points[a] - zero), "end": int(points[b] - zero)} for a, k, b in found])
                    if mask_text:
                        texts.append(_masked(data, offs[i], offs[i + 1], found, mask.encode()) if column[at + i].is_valid else None)
            cols = list(batch.columns)
            if mask_text:
                cols[at_text] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(spans, kind)], names=[*kept, "secrets"])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*kept).dtypes)
    return docs.select(*kept).mapInArrow(run, schema + ", secrets array<struct<kind:string,start:bigint,end:bigint>>")


def _masked(data: bytes, lo: int, hi: int, spans: list[tuple[int, int, int]], mask: bytes) -> str:
    out, at = [], lo
    for a, _, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [data[at:a], mask]
        at = b
    return b"".join([*out, data[at:hi]]).decode()


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, their hash, and all spans as text."""
    text = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of = lambda k: F.size(F.filter("secrets", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("secrets", lambda x: x["kind"] != "crf")
    found = secrets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return found.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("secrets")).alias("spans"))
