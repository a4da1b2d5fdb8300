"""Signature sniffing against search by hand, and media read back."""

import hashlib
import io
import random
import struct
import wave
import zlib

import numpy as np
import pytest

pytest.importorskip("tarnfold.llm")

from tarnfold.llm import media

SAMPLES = bytes(random.Random(5).randrange(256) for _ in range(3 * media.UNIT))


def gif():
    head = b"GIF89a" + struct.pack("<HHBBB", 2, 1, 0x80, 0, 0) + bytes(6)
    return head + b"\x21\xf9\x04\0\0\0\0\0" + b"\x2c" + struct.pack("<HHHHB", 0, 0, 2, 1, 0) + b"\x02\x02\x44\x0a\0" + b"\x3b"


def jpeg():
    scan = b"\x11\xff\x00\x22\xff\xd3\x33" * 4
    return b"\xff\xd8\xff\xe0\x00\x10JFIF\0\1\1\0\0\1\0\1\0\0" + b"\xff\xc0\x00\x0b\x08\0\1\0\1\1\1\x11\0" + b"\xff\xda\x00\x08\x01\x01\0\0\x3f\0" + scan + b"\xff\xd9"


def mp4():
    box = lambda name, body: struct.pack(">I", 8 + len(body)) + name + body
    return box(b"ftyp", b"isom\0\0\0\1isom") + box(b"free", b"") + box(b"mdat", b"frames") + box(b"moov", b"tracks")


FILES = {k: media.encode(k, SAMPLES) for k in media.KINDS} | {"gif": gif(), "jpeg": jpeg(), "mp4": mp4(), "ppm": b"P6 # a note\n4 2\n255\n" + bytes(24), "webp": b"RIFF" + struct.pack("<I", 16) + b"WEBPVP8 " + struct.pack("<I", 4) + b"abcd"}


def plain(data):
    """All media by trying each validator at every place, the outermost first."""
    found, free = [], 0
    for at in range(len(data)):
        if at < free:
            continue
        for magic, kind, before in media.SIGNATURES:
            if data[at + before : at + before + len(magic)] == magic and (end := media.validators()[kind](data, at)):
                found.append((media.RIFF_FORMS.get(data[at + 8 : at + 12], kind) if kind == "riff" else kind, at, end - at))
                free = end if at else 0
                break
    return found


def sniffed(data):
    return [(m.kind, m.offset, m.length) for m in media.find_media(data, media.automaton())]


@pytest.mark.parametrize("kind", sorted(FILES))
def test_each_format(kind):
    whole = FILES[kind]
    assert sniffed(whole)[0] == (kind, 0, len(whole))
    assert (kind, 7, len(whole)) in sniffed(b"prefix " + whole + b"BM and P5 and RIFF, no media")
    assert not [m for m in sniffed(whole[: len(whole) - 3]) if m[0] == kind and m[1] == 0]


def test_libraries_read_what_is_written():
    with wave.open(io.BytesIO(FILES["wav"])) as f:
        assert (f.getnchannels(), f.getsampwidth(), f.readframes(f.getnframes())) == (1, 1, SAMPLES)
    body = FILES["png"].index(b"IDAT")
    rows = np.frombuffer(zlib.decompress(FILES["png"][body + 4 : -16]), np.uint8).reshape(-1, media.UNIT + 1)
    assert rows[:, 1:].tobytes() == SAMPLES
    for kind in media.KINDS:
        assert media.decode(kind, FILES[kind]) == SAMPLES
    odd = SAMPLES[: 3 * 7]
    assert media.decode("bmp", media.encode("bmp", odd, 7)) == odd and media.decode("wav", media.encode("wav", odd)) == odd
    with pytest.raises(ValueError, match="8 bits"):
        media.decode("gif", FILES["gif"])


def test_png_filters():
    rng, width, step = random.Random(6), 5, 3
    rows = np.array([[rng.randrange(256) for _ in range(width * step)] for _ in range(6)], np.uint8)
    filtered = np.zeros((6, width * step + 1), np.uint8)
    for i in range(6):
        filtered[i, 0] = kind = (0, 1, 2, 3, 4, 4)[i]
        for k in range(width * step):
            a, b, c = (int(rows[i, k - step]) if k >= step else 0), (int(rows[i - 1, k]) if i else 0), (int(rows[i - 1, k - step]) if i and k >= step else 0)
            p = a + b - c
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
            filtered[i, k + 1] = (int(rows[i, k]) - (0, a, b, (a + b) // 2, paeth)[kind]) & 255
    assert (media.unfiltered(filtered, step) == rows).all()


def test_sniffing_is_the_plain_search():
    rng = random.Random(7)
    bits = [*FILES.values(), b"BM", b"P5 ", b"RIFF", b"\xff\xd8\xff\xda", b"\x89PNG\r\n\x1a\n", b".snd", b"\0\0\0\x08ftyp", *(f[: len(f) // 2] for f in FILES.values())]
    for _ in range(60):
        data = b"".join(rng.choice(bits) if rng.random() < 0.6 else rng.randbytes(rng.randrange(40)) for _ in range(rng.randrange(9)))
        assert sniffed(data) == plain(data)


def test_sniff_and_carve(spark):
    wav = FILES["wav"]
    holder = media.png(SAMPLES, media.UNIT) + wav
    rows = [(1, "png", wav), (1, "wav", wav), (2, "gif", holder), (3, None, b"text " + FILES["gif"] + jpeg()), (4, "wav", b""), (5, "wav", None), (None, "wav", wav[:-1])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id long, declared string, media binary, kind string, length int")
    got = {(r.id, r.declared): r for r in media.sniff(df, "id", "media", "declared").collect()}
    assert len(got) == 7 and (got[1, "png"].kind, got[1, "png"].declared_right, got[1, "wav"].declared_right) == ("wav", False, True)
    assert [(m.kind, m.length) for m in got[2, "gif"].embedded] == [("wav", len(wav))] and got[2, "gif"].length == len(holder) - len(wav)
    assert got[3, None].kind is None and [m.kind for m in got[3, None].embedded] == ["gif", "jpeg"]
    assert all(got[k].kind is None and got[k].n_bytes == n for k, n in (((4, "wav"), 0), ((5, "wav"), 0), ((None, "wav"), len(wav) - 1)))
    carved = sorted((r.id, r.kind, bytes(r.media)) for r in media.carve(df, "id", "media", "declared").collect())
    assert carved == [(2, "wav", wav), (3, "gif", FILES["gif"]), (3, "jpeg", jpeg())]
    assert media.sniff(df.limit(0), "id", "media", "declared").count() == 0


def test_texts_as_media(spark):
    texts = ["", None, "a", "x" * 576, "é" * 400, "long " * 40_000, "a", "P5 2 2 255\nabcd and BM", *(f"text {i}" * 50 for i in range(30))]
    df = spark.createDataFrame([(i if i != 6 else None, t, "x", 3) for i, t in enumerate(texts)] + [(2, "a", "x", 3)], "doc_id long, text string, media string, n_bytes int")
    got = media.media_features(df).collect()
    assert len(got) == len(texts) + 1 and len({r.kind for r in got}) == len(media.KINDS)
    by_text = {}
    for r in got:
        text = (texts[r.doc_id] if r.doc_id is not None else "a") or ""
        data = text.encode()
        payload = data + b"\xff" * (576 if not data else -len(data) % 576)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        stored = media.encode(r.kind, payload)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert len(by_text.setdefault(text, {tuple(r)[1:]})) == 1 and tuple(r)[1:] in by_text[text]
    assert "embedded=pgm" in got[7].feature or got[7].kind == "png"
    assert media.media_features(df.limit(0)).count() == 0
