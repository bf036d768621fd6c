"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon has a weight for each word (and word beginning) that toxic training documents
have more often than others: plain insults are listed, the rest is learnt. While trees are
fitted, a document's own fold is left out of the lexicon counts, so that words it alone has
don't count for it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import trees
from .bytetext import chunks, lower_ascii, prefix_sums, spans_hash, word_spans, _BYTE
from .sample import SAMPLE_DOCS, fold, learnt, sample_rows
from .work import python_ready

# Insults in plain form, and pronouns that address the reader.
INSULTS = "idiot idiots stupid moron morons trash scum loser losers pathetic worthless disgusting clown clowns dumb fool imbecile jerk garbage filth vermin creep coward liar pig rat freak".split()
SECOND_PERSON = "you your yours yourself u ur youre du dich dir dein deine ihr euch tu toi te ton ta vous votre usted ustedes ti tus".split()

FEATURES = ("log_words", "lexicon_density", "lexicon_hits", "lexicon_top", "lexicon_weight", "prefix_density", "prefix_top", "second_person", "second_person_near", "capitals", "exclamation", "punctuation", "symbols", "digits", "mixed_words", "obfuscated_hits", "repeated_words", "local_hits")
PREFIX_BYTES, NEAR, LOCAL = 7, 5, 20

_CLASS = np.zeros(256, np.uint8)  # 1 letter, 2 digit, 3 punctuation, 4 symbol
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2
_CLASS[[ord(c) for c in ".,;:?!'\"()-"]] = 3
_CLASS[[ord(c) for c in "#*$%&|<>@^_~+=/\\{}[]`"]] = 4
_PLAIN = np.arange(256).astype(np.uint8)  # letters that digits and signs stand for
for _a, _b in zip("013457@", "oieasta", strict=True):
    _PLAIN[ord(_a)] = ord(_b)


def _letters(raw: np.ndarray, offs: np.ndarray, plain: bool):
    """Hashes of words with only their letters, word count bounds, hashes of their beginnings."""
    raw = lower_ascii(raw)
    if plain:
        raw = _PLAIN[raw]
    keep = (_CLASS[raw] == 1) | (raw == 32) | ((raw >= 9) & (raw <= 13))
    at = np.concatenate([[0], np.cumsum(keep)])
    raw, offs = raw[keep], at[offs]
    start, end, bounds = word_spans(raw, offs)
    prefix = prefix_sums(_BYTE[raw])
    long = end - start >= PREFIX_BYTES
    head = np.where(long, spans_hash(prefix, start, np.minimum(start + PREFIX_BYTES, end)), np.uint64(0))
    return spans_hash(prefix, start, end), bounds, head


def _hash(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return np.unique(_letters(raw, np.array([0, len(raw)]), False)[0])


_YOU, _LISTED = _hash(SECOND_PERSON), _hash(INSULTS)


def _weight(h: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    keys, weight = table
    if not len(keys):
        return np.zeros(len(h))
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[at] == h, weight[at], 0.0)


def features(raw: np.ndarray, offs: np.ndarray, words: tuple, heads: tuple) -> np.ndarray:
    """The FEATURES of each text; a text without words has zeros but for character rates."""
    n = len(offs) - 1
    h, bounds, head = _letters(raw, offs, False)
    rows = lambda v, b: np.diff(np.concatenate([[0.0], np.cumsum(v)])[b])  # noqa: E731  sums by row
    row = np.repeat(np.arange(n), np.diff(bounds))

    def top(v: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        np.maximum.at(out, row[v > 0], v[v > 0])
        return out

    w, p = _weight(h, words), _weight(head, heads)
    hit, you = w > 0, np.isin(h, _YOU)

    def within(v: np.ndarray, k: int) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(v)])
        i = np.arange(len(v))
        lo, hi = np.maximum(i - k, bounds[:-1][row]), np.minimum(i + k + 1, bounds[1:][row])
        return total[hi] - total[lo]

    size = np.maximum(np.diff(bounds), 1)
    kind = _CLASS[raw]
    chars = np.maximum(np.diff(offs), 1)
    upper = rows((raw >= 65) & (raw <= 90), offs)
    letters = np.maximum(rows(kind == 1, offs), 1)
    start, end, wb = word_spans(raw, offs)
    other = np.concatenate([[0], np.cumsum((kind == 2) | (kind == 4))])
    alpha = np.concatenate([[0], np.cumsum(kind == 1)])
    mixed = (other[np.maximum(end - 1, start)] > other[np.minimum(start + 1, end)]) & (alpha[end] > alpha[start])
    h2, b2, _ = _letters(raw, offs, True)
    hidden = np.maximum(rows(_weight(h2, words) > 0, b2) - rows(hit, bounds), 0)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    near = hit & (within(you, NEAR) > 0)
    local = top(np.where(hit, within(hit, LOCAL // 2), 0).astype(float))
    hits = rows(hit, bounds)
    return np.stack(
        [np.log1p(np.diff(bounds)), hits / size, np.log1p(hits), top(w), np.log1p(rows(w, bounds)), rows(p > 0, bounds) / size, top(p), rows(you, bounds) / size, rows(near, bounds) / size, upper / letters, rows(raw == 33, offs) / chars, rows(kind == 3, offs) / chars, rows(kind == 4, offs) / chars, rows(kind == 2, offs) / chars, rows(mixed, wb) / size, np.log1p(hidden), rows(again, bounds) / size, local],
        axis=1,
    )


def _tables(counts: list[np.ndarray], keys: np.ndarray, toxic: float, clean: float, listed: np.ndarray):
    """Words with weights: the log of how much more often toxic documents have them."""
    t, c = counts
    odds = np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1))
    weight = np.where((t >= 3) & (odds >= 1.5), odds, 0.0)
    known = np.isin(keys, listed)
    weight[known] = np.maximum(weight[known], 3.0)
    extra = listed[~np.isin(listed, keys)]
    on = weight > 0
    k, w = np.concatenate([keys[on], extra]), np.concatenate([weight[on], np.full(len(extra), 3.0)])
    order = np.argsort(k)
    return k[order], w[order]


def train(rows: list) -> dict:
    """Fit lexicon, trees and calibration on (doc_id, text, label) rows; none is held out."""
    rows = [r for r in rows if fold(r[0])]
    y, f = np.array([r[2] for r in rows], float), np.array([fold(r[0]) for r in rows])
    seen: dict[str, list] = {"word": [], "head": []}
    parts = list(chunks(pa.array([r[1] for r in rows], pa.string())))
    for _, _, raw, offs in parts:
        h, bounds, head = _letters(raw, offs, False)
        for i in range(len(offs) - 1):
            seen["word"].append(np.unique(h[bounds[i] : bounds[i + 1]]))
            seen["head"].append(np.unique(head[bounds[i] : bounds[i + 1]]))

    def tables(kind: str, use: np.ndarray, listed: np.ndarray):
        got = [s for s, u in zip(seen[kind], use, strict=True) if u]
        flat = np.concatenate(got or [np.zeros(0, np.uint64)])
        label = np.repeat(y[use], [len(s) for s in got])
        ok = flat > 0
        keys, at = np.unique(flat[ok], return_inverse=True)
        return _tables([np.bincount(at, label[ok], len(keys)), np.bincount(at, 1 - label[ok], len(keys))], keys, y[use].sum(), (1 - y[use]).sum(), listed)

    none = np.zeros(0, np.uint64)
    x = np.zeros((len(rows), len(FEATURES)))
    for k in range(1, 5):
        words, heads = tables("word", f != k, _LISTED), tables("head", f != k, none)
        for at, to, raw, offs in parts:
            mine = np.flatnonzero(f[at:to] == k)
            if len(mine):
                x[at + mine] = features(raw, offs, words, heads)[mine]
    model = {"words": tables("word", f > 0, _LISTED), "heads": tables("head", f > 0, none)}
    fit_on = f != 4 if len(np.unique(y[f != 4])) == 2 else f > 0
    model["trees"] = trees.fit(x[fit_on], y[fit_on])
    cal = f == 4 if len(np.unique(y[f == 4])) == 2 else f > 0
    model["knots"] = trees.isotonic(trees.raw_score(model["trees"], x[cal]), y[cal]) if cal.any() else (np.array([-1.0, 1.0]), np.array([0.0, 1.0]))
    return model


def score_column(column, model: dict) -> np.ndarray:
    out = np.zeros(len(column))
    for at, to, raw, offs in chunks(column):
        x = features(raw, offs, model["words"], model["heads"])
        out[at:to] = np.interp(trees.raw_score(model["trees"], x), *model["knots"])
    return np.clip(out, 0.0, 1.0)


def fitted(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_DOCS) -> dict:
    """``train`` on the sample, in one task of an executor, so the driver only gets the model."""
    return learnt(sample_rows(docs, labels, "toxic", limit), train)


def toxicity(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_DOCS) -> DataFrame:
    """The rows of ``docs`` with held_out, score (0 to 1) and predicted (1 if score >= 0.5).

    Labels are learnt from a sample of at most ``limit`` labelled documents that are not held
    out; the score depends on the text alone.
    Null and empty texts are scored like a text without words. Null ids are held_out false.
    Without labels of both classes the score is constant. Columns of those names that
    ``docs`` has are replaced; others are kept. No rows give no rows.
    """
    python_ready(docs.sparkSession)
    model = fitted(docs, labels, limit)
    kept = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    at = kept.index("text")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score_column(batch.column(at), model))], names=[*kept, "score"])

    out = docs.select(*kept).mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in docs.select(*kept).dtypes) + ", score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select(*kept, held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
