import hashlib
import io
import os
import re
from zlib import crc32

import numpy as np
import pytest
from egolake.llm import jpeg, pieces, queries

from .common import TEXTS, documents

sentencepiece = pytest.importorskip("sentencepiece")
try:
    PATH = queries.piece_model()
except ImportError:
    PATH = None
needs_model = pytest.mark.skipif(not PATH, reason="no tokenizer files")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "   a   b  ", "\n", "▁", "a▁b", "▁ ▁ a", "日本語 テスト", "😀 x😀", "\t tab", "é̀", "a\x00b", "<s> <0x0A>", "　 full", "ﬁ ① Ａ", "�", "x" * 300, "ab" * 40 + " " * 20 + "z"]


def key(rows):
    return sorted(rows, key=str)


@needs_model
def test_ids_against_the_library_and_spans_cover_the_text():
    lib, m = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.PieceModel(PATH)
    for t in ODD + [t or "" for _, t in TEXTS]:
        ids, starts, ends, joined = m.encode(t)
        assert ids.tolist() == lib.encode(t) and joined == ",".join(map(str, ids))
        assert m._encode_any(t)[0].tolist() == ids.tolist()
        data = t.encode()
        if len(ids):
            assert starts[0] == 0 and ends[-1] == len(data) and (starts[1:] == ends[:-1]).all()
        for i, a, b in zip(ids.tolist(), starts, ends, strict=True):
            piece = lib.id_to_piece(i)
            got = data[a:b].decode(errors="replace").replace(" ", "▁")
            assert lib.is_byte(i) and b - a == 1 or piece in (got, "▁" + got)
    assert [x[0].tolist() for x in m.encode_all(ODD)] == [lib.encode(t) for t in ODD]


@needs_model
def test_merges_against_the_library():
    lib, m = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.PieceModel(PATH)
    for t in ODD[9:] + ["thequickbrownfox" * 9, "internationalisation", "1234567890" * 10]:
        if t and not t.isspace():
            assert [i for w in [m.normalise(t)[0]] for i, *_ in m.pieces(w)] == lib.encode(t)


@needs_model
def test_texts_are_encoded_without_the_library(monkeypatch):
    monkeypatch.setattr(pieces, "decoder", lambda path: pytest.fail("the library encodes"))
    m, lib = pieces.PieceModel(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ODD + [t or "" for _, t in TEXTS] + ["naïve façade 日本 x" * 5 + " unbelievably 12345 " + "z" * 47, "a" * 48 + " " + "b" * 49]
    for t, (ids, starts, ends, _) in zip(texts, m.encode_all(texts), strict=True):
        assert ids.tolist() == lib.encode(t)
        want = m._encode_any(t)
        assert starts.tolist() == want[1].tolist() and ends.tolist() == want[2].tolist()
    words = sorted({w for t in texts for w in re.findall("▁*[^▁]+|▁+", m.normalise(t)[0])})
    chars = np.array([m.char_symbol[ord(c)] for w in words for c in w])
    sym, word = m.merge_all(chars, np.repeat(np.arange(len(words)), [len(w) for w in words]))
    names = [*m.symbol]
    for i, w in enumerate(words):
        assert [names[k] if k >= 0 else None for k in sym[word == i]] == [p if p in m.symbol else None for p in m.merge(w)]


@needs_model
def test_very_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(pieces, "ENCODE_CHARS", 200)
    m, lib = pieces.PieceModel(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for t in (TEXTS[0][1] * 3, "a  b " * 200, "é日 ▁x" * 150, "z" * 900, " " * 700):
        ids, starts, ends, _ = m.encode(t)
        want = m._encode_any(t)
        assert ids.tolist() == lib.encode(t)
        assert starts.tolist() == want[1].tolist() and ends.tolist() == want[2].tolist()


@needs_model
def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(pieces, "mix", lambda x: np.zeros(len(x), np.uint64))
    m, lib = pieces.PieceModel(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [t or "" for _, t in TEXTS[:9]]
    assert [g[0].tolist() for g in m.encode_all(texts)] == [lib.encode(t) for t in texts]


@needs_model
@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc"])
def test_texts_with_mapped_prefixes_are_found(rule):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = dict(pieces._fields(dict(pieces._fields(lib.serialized_model_proto()))[3]))
    m = pieces.PieceModel(PATH)
    m.map = pieces.CharacterMap(spec[2])
    for t in ODD:
        data = t.encode()
        want = [m.map.longest(data, i) is not None for i in range(len(data))]
        assert m.map.maps(np.frombuffer(data, np.uint8)).tolist() == want
    for t, got in zip(ODD, m.encode_all(ODD), strict=True):
        assert [x.tolist() for x in got[:3]] == [x.tolist() for x in m._encode_any(t)]


@needs_model
@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("dummy", [False, True])
@pytest.mark.parametrize("squeeze", [False, True])
def test_normalising_against_the_library(rule, dummy, squeeze):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=dummy, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    spec = dict(pieces._fields(dict(pieces._fields(lib.serialized_model_proto()))[3]))
    m = pieces.PieceModel(PATH)
    m.map, m.dummy, m.squeeze = pieces.CharacterMap(spec.get(2, b"")), dummy, squeeze
    for t in ODD:
        norm, source = m.normalise(t)
        assert norm == lib.normalize(t)
        assert len(source) == len(norm) + 1 and source == sorted(source) and source[-1] <= len(t.encode())
    if rule == "nfkc":
        norm, source = m.normalise("aﬁb")
        assert norm[-4:] == "afib"[-4:] and source[-4:] == [1, 1, 4, 5]  # both letters come from the ligature


@needs_model
def test_piece_columns(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [(d, t) for d, t in TEXTS]
    out = pieces.digest(documents(spark, rows, ("ids", "n_tokens")), PATH).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = key((d, len(i := lib.encode(t or "")), sha(",".join(map(str, i))), sha(lib.decode(i)), len((t or "").encode())) for d, t in rows)
    assert key((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.n_bytes) for r in out) == want
    full = pieces.encoded(documents(spark, rows, ("starts",)), PATH).collect()
    assert key(tuple(r.ids) for r in full) == key(tuple(lib.encode(t or "")) for _, t in rows)
    assert pieces.digest(documents(spark, []), PATH).count() == 0 and pieces.encoded(documents(spark, []), PATH).count() == 0


# JPEG ----------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 575, 576, 577, 4000, 90_000])
def test_payload_round_trip(n):
    data = jpeg.padded(os.urandom(n))
    assert len(data) % 576 == 0 and len(data) >= 576
    media = jpeg.encode(data)
    image = jpeg.decode(media)
    assert jpeg.payload(image) == data and jpeg.encode(data) == media
    assert jpeg.rgb(image).shape == (image.height, image.width, 3)


def test_media_column(spark):
    out = jpeg.digest(documents(spark, clash=("media", "feature"))).collect()
    want = []
    for d, t in TEXTS:
        raw = (t or "").encode()
        p = jpeg.padded(raw)
        m = jpeg.encode(p)
        want.append((d, len(raw), len(p), hashlib.sha256(p).hexdigest(), crc32(p[-32:]), len(m), hashlib.sha256(m).hexdigest()))
    assert key(tuple(r)[:7] for r in out) == key(want)
    by = {}
    for r in out:
        assert by.setdefault(r.media_sha256, r.feature) == r.feature
    assert len({r.feature for r in out}) == len(by)
    assert jpeg.digest(documents(spark, [])).count() == 0
    t = jpeg.tensors(jpeg.media_column(documents(spark))).collect()
    assert all(len(r.rgb) == 3 * r.height * r.width for r in t)
    none = spark.createDataFrame([(None,)], "media binary")
    assert jpeg.tensors(none).collect()[0].rgb is None


def java_image(spark, pixels):
    jvm = spark.sparkContext._jvm
    h, w = pixels.shape[:2]
    grey = pixels.ndim == 2
    kind = jvm.java.awt.image.BufferedImage(w, h, 10 if grey else 1)
    raster = kind.getRaster()
    flat = spark.sparkContext._gateway.new_array(jvm.int, pixels.size)
    for i, v in enumerate(pixels.ravel().tolist()):
        flat[i] = v
    raster.setPixels(0, 0, w, h, flat)
    return kind


def java_jpeg(spark, pixels, quality):
    jvm = spark.sparkContext._jvm
    out = jvm.java.io.ByteArrayOutputStream()
    writer = jvm.javax.imageio.ImageIO.getImageWritersByFormatName("jpeg").next()
    par = writer.getDefaultWriteParam()
    par.setProgressiveMode(1)
    par.setCompressionMode(2)
    par.setCompressionQuality(quality)
    stream = jvm.javax.imageio.ImageIO.createImageOutputStream(out)
    writer.setOutput(stream)
    writer.write(None, jvm.javax.imageio.IIOImage(java_image(spark, pixels), None, None), par)
    stream.flush()
    return bytes(out.toByteArray())


def java_pixels(spark, data):
    jvm = spark.sparkContext._jvm
    image = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(data))
    h, w, bands = image.getHeight(), image.getWidth(), image.getRaster().getNumBands()
    got = image.getData().getPixels(0, 0, w, h, spark.sparkContext._gateway.new_array(jvm.int, w * h * bands))
    return np.array(list(got)).reshape(h, w, bands)


@pytest.mark.parametrize("quality", [0.3, 0.9])
@pytest.mark.parametrize("size", [(16, 16), (37, 21), (8, 50)])
def test_progressive_images_of_another_encoder(spark, quality, size):
    """Grey images of Java's progressive encoder decode to the same samples as with its decoder."""
    rng = np.random.default_rng(3)
    y, x = np.mgrid[: size[0], : size[1]]
    pixels = np.clip(128 + 90 * np.sin(x / 5) * np.cos(y / 7) + rng.normal(0, 20, size), 0, 255).astype(int)
    data = java_jpeg(spark, pixels, quality)
    assert b"\xff\xc2" in data
    got = jpeg.rgb(jpeg.decode(data))
    assert np.abs(got[..., 0].astype(int) - java_pixels(spark, data)[..., 0]).max() <= 2


def test_colour_images_and_our_own_stream_in_another_decoder(spark):
    y, x = np.mgrid[:40, :56]
    flat = np.stack([100 + x, 60 + 2 * y, 200 - x - y], -1)
    data = java_jpeg(spark, flat, 0.95)
    image = jpeg.decode(data)
    assert len(image.parts) == 3
    assert np.abs(jpeg.rgb(image).astype(int) - flat).mean() < 4
    own = jpeg.encode(jpeg.padded(b"some text that is stored" * 40))
    mine, theirs = jpeg.rgb(jpeg.decode(own)).astype(int), java_pixels(spark, own)
    assert mine.shape == theirs.shape
    assert np.abs(mine.mean(2) - theirs.mean(2)).mean() < 40  # the decoders upsample chroma differently


def test_damaged_streams_are_refused():
    data = jpeg.encode(jpeg.padded(b"x" * 2000))
    for bad in (b"", data[:40], b"GIF8" + data[4:], data[:-400] + b"\xff\xd9"):
        with pytest.raises((ValueError, IndexError)):
            jpeg.decode(bad)
    assert io.BytesIO(data).read(2) == b"\xff\xd8"
