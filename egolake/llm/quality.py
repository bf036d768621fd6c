"""Quality rules: exact counts of a text, and content or boilerplate by line.

Lines are labelled by Viterbi decoding of a linear-chain conditional random field over line
features; the share of words in content lines decides whether a text is retained.

Only documents are labelled, not their lines, so the field is fitted by hard expectation
maximisation: lines that are plainly one kind (many signs, repeats, capitals; sentences of
prose) are seeds, the others start with the label of their document, are labelled anew by the
field, and keep that while their document as a whole still agrees with its label. Chains in
which lines of a rejected document stand before, in and after those of a retained one teach
the field where labels change.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from .bytetext import _BYTE, chunks, gram_starts, prefix_sums, spans_hash, word_spans
from .sample import learnt, sample_rows
from .work import python_ready

CONTENT, BOILERPLATE = 0, 1
#: Least share of words in content lines of a retained text.
CONTENT_SHARE = 0.5
#: Documents that the field is fitted on, consecutive lines of each (from a place by a hash), rounds, and chains of two documents.
FIT_DOCS, FIT_LINES, ROUNDS, SPLICED = 3000, 60, 2, 600

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
COLUMNS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, content_words long"
N_FEATURES = 16


def _repeated(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether its row has it more than once, and whether this one isn't the first."""
    order = np.lexsort((keys, row))
    k, r = keys[order], row[order]
    same = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    twice, later = np.zeros(len(k), bool), np.zeros(len(k), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    later[order[1:][same]] = True  # lexsort is stable: the first of a group stays first
    return twice, later


def measure(raw: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of each text, and its lines with their features."""
    n = len(offs) - 1
    start, end, bounds = word_spans(raw, offs)
    doc = np.repeat(np.arange(n), np.diff(bounds))
    sums = lambda v, b: np.diff(np.concatenate([[0], np.cumsum(v)])[b])
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    length = points[end] - points[start]
    prefix = prefix_sums(_BYTE[raw])
    h = spans_hash(prefix, start, end)
    # words in windows of five that the text has twice
    begin, of = gram_starts(bounds, 5)
    word_prefix = prefix_sums(h)
    twice, _ = _repeated(spans_hash(word_prefix, begin, begin + 5), np.repeat(np.arange(n), np.diff(of)))
    mark = np.zeros(len(h) + 6, np.int64)
    np.add.at(mark, begin[twice], 1)
    np.add.at(mark, begin[twice] + 5, -1)
    covered = np.cumsum(mark)[: len(h)] > 0
    # lines: a text of k line ends has k + 1
    nl = np.flatnonzero(raw == 10)
    owner = np.searchsorted(offs, nl, "right") - 1
    per = np.bincount(owner, minlength=n) + 1
    lb = np.concatenate([[0], np.cumsum(per)])
    line_start = np.zeros(lb[-1], np.int64)
    first = np.zeros(lb[-1], bool)
    first[lb[:-1]] = True
    line_start[first] = offs[:-1]
    line_start[~first] = nl + 1
    line_end = np.concatenate([line_start[1:] - 1, [0]])[: len(line_start)]
    line_end[lb[1:] - 1] = offs[1:]
    line_doc = np.repeat(np.arange(n), per)
    breaks = np.concatenate([[0], np.cumsum(raw == 10)])
    word_line = lb[doc] + breaks[start] - breaks[offs[:-1]][doc]
    line_words = np.bincount(word_line, minlength=lb[-1])
    _, later = _repeated(spans_hash(prefix, line_start, line_end), line_doc)
    dup = later & (line_words > 0)
    return {
        "n_words": np.diff(bounds),
        "word_chars": sums(length, bounds),
        "n_symbols": sums(_SYMBOL[raw], offs),
        "n_dup_lines": sums(dup, lb),
        "n_repeat_words": sums(covered, bounds),
        "bounds": lb,
        "line_words": line_words,
        "x": _line_features(raw, line_start, line_end, line_words, word_line, h, length, covered, dup, start, end, line_doc, lb),
    }


def _line_features(raw, line_start, line_end, line_words, word_line, h, length, covered, dup, start, end, line_doc, lb) -> np.ndarray:
    n = len(line_start)
    by_char = lambda m: (lambda c: c[line_end] - c[line_start])(np.concatenate([[0], np.cumsum(m)]))
    by_word = lambda v: np.bincount(word_line, v.astype(float), n)
    chars, words = np.maximum(line_end - line_start, 1), np.maximum(line_words, 1)
    upper, lower = by_char((raw >= 65) & (raw <= 90)), by_char((raw >= 97) & (raw <= 122))
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (word_line[1:] == word_line[:-1])
    caps = upper / np.maximum(upper + lower, 1)
    symbol, repeat, cover = by_char(_SYMBOL[raw]) / chars, by_word(again) / words, by_word(covered) / words
    bang = by_char(raw == 33) / words
    last = raw[np.maximum(line_end - 1, 0)] if len(raw) else np.zeros(n, np.uint8)
    stop = (line_end > line_start) & np.isin(last, [46, 33, 63])
    at = np.arange(n) - lb[line_doc]
    f = [np.ones(n), line_words == 0, line_words <= 2, line_words <= 5, np.minimum(np.log1p(line_words), 6) / 3, symbol > 0.02, np.minimum(symbol * 10, 1), caps > 0.6, repeat > 0.2, np.minimum(cover, 1), bang > 0.2, by_char(raw == 124) / words > 0.2, dup, stop, by_char((raw >= 48) & (raw <= 57)) / chars > 0.3, at == 0]
    assert len(f) == N_FEATURES
    return np.stack([np.asarray(v, float) for v in f], axis=1)


def seeds(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Labels of lines whose features (see ``_line_features``) leave no doubt, -1 for others."""
    symbol, caps, repeat, cover, bang, pipes, dup, stop = (x[:, k] for k in (6, 7, 8, 9, 10, 11, 12, 13))
    out = np.full(len(x), -1)
    out[(words >= 8) & (stop > 0) & (symbol == 0) & (caps == 0) & (repeat == 0) & (cover < 0.2) & (bang == 0) & (dup == 0)] = CONTENT
    out[(symbol >= 0.3) | (pipes > 0) | (bang > 0) & (caps > 0) | (repeat > 0) & (words > 4) | (dup > 0)] = BOILERPLATE
    return out


def learn(rows: list[tuple]) -> crf.Chain:
    """Fit the field on (doc_id, text, quality) rows; without both kinds every line is content."""
    empty = crf.Chain(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    if len({r[2] for r in rows}) < 2:
        return empty
    docs = []  # features, words, label of the document, seeds
    at = 0
    for _, to, raw, offs in chunks(pa.array([r[1] for r in rows], pa.string())):
        got = measure(raw, offs)
        for i in range(len(offs) - 1):
            a, b = got["bounds"][i], got["bounds"][i + 1]
            a += crc32(str(rows[at + i][0]).encode()) % max(1, b - a - FIT_LINES + 1)
            b = min(b, a + FIT_LINES)
            x, words = got["x"][a:b], got["line_words"][a:b]
            docs.append((x, words, CONTENT if rows[at + i][2] else BOILERPLATE, seeds(x, words)))
        at = to

    def agrees(y: np.ndarray, words: np.ndarray, kind: int) -> bool:
        return (words[y == CONTENT].sum() >= CONTENT_SHARE * words.sum()) == (kind == CONTENT)

    start = [np.where(s < 0, kind, s) for _, _, kind, s in docs]
    start = [y if agrees(y, words, kind) else np.full(len(y), kind) for y, (_, words, kind, _) in zip(start, docs, strict=True)]
    now = start
    for k in range(ROUNDS + 1):
        chains = [(x, y) for (x, *_), y in zip(docs, now, strict=True)]
        good, bad = ([c for c, d in zip(chains, docs, strict=True) if d[2] == kind] for kind in (CONTENT, BOILERPLATE))
        for i, ((gx, gy), (bx, by)) in enumerate(zip(good[:SPLICED], (bad * (1 + len(good) // len(bad)))[:SPLICED], strict=False)):
            cut = (0, len(gy) // 2, len(gy))[i % 3]
            n = min(len(by), 1 + i % 4)
            chains.append((np.concatenate([gx[:cut], bx[:n], gx[cut:]]), np.concatenate([gy[:cut], by[:n], gy[cut:]])))
        field = crf.fit(chains, 2, N_FEATURES)
        if k == ROUNDS:
            return field
        bounds = np.concatenate([[0], np.cumsum([len(y) for y in now])])
        found = crf.viterbi(np.concatenate([d[0] for d in docs]) @ field.emit, bounds, field)
        now = []
        for i, (_, words, kind, s) in enumerate(docs):
            y = np.where(s < 0, found[bounds[i] : bounds[i + 1]], s)
            now.append(y if agrees(y, words, kind) else start[i])
    return empty


def fitted(docs: DataFrame, labels: DataFrame, limit: int = FIT_DOCS) -> crf.Chain:
    """``learn`` on at most ``limit`` labelled documents, in one task of an executor."""
    return learnt(sample_rows(docs, labels, "quality", limit), learn)


def quality(docs: DataFrame, labels: DataFrame, limit: int = FIT_DOCS, share: float = CONTENT_SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, content_share, kept.

    Null texts read as empty. A text without words fails the base rules (fewer than ten
    words) and has a content share of 0. Lines that only repeat count from their second
    occurrence. Other columns of ``docs`` are ignored; rows that repeat are separate rows;
    no rows give no rows.
    """
    python_ready(docs.sparkSession)
    field = fitted(docs, labels, limit)

    def run(batches):
        for batch in batches:
            for at, to, raw, offs in chunks(batch.column(1)):
                got = measure(raw, offs)
                label = crf.viterbi(got["x"] @ field.emit, got["bounds"], field)
                words = np.concatenate([[0], np.cumsum(got["line_words"] * (label == CONTENT))])
                content = words[got["bounds"][1:]] - words[got["bounds"][:-1]]
                cols = [got[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                cols += [np.diff(got["bounds"]), content]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), *(pa.array(c.astype(np.int64)) for c in cols)], names=[c.split()[0] for c in COLUMNS.split(", ")])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, COLUMNS)
    part = F.coalesce(F.try_divide(F.col("content_words").cast("double"), F.col("n_words")), F.lit(0.0))
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return out.withColumn("content_share", part).withColumn("kept", ~F.col("base_failed") & (part >= share))
