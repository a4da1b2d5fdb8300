"""Media columns: signature sniffing with Aho-Corasick (operator 11).

One automaton over the signatures of all formats reads a value once and says
where any of them stands.  What a format's validator then confirms, by walking
its structure and lengths to its end, is media: at the value's start it is the
value's true type, whatever was declared, and anywhere else media embedded in it
or appended to it, which is carved out.

Texts are stored as media by ``store_texts``, their bytes as samples of 8 bits,
and read back through ``sniff``.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ._shared import binary, materialize, sliced, workspace

# The formats' signatures, and how far into the format they stand.
SIGNATURES = [
    (b"\x89PNG\r\n\x1a\n", "png", 0),
    (b"\xff\xd8\xff", "jpeg", 0),
    (b"GIF87a", "gif", 0),
    (b"GIF89a", "gif", 0),
    (b"BM", "bmp", 0),
    (b"RIFF", "riff", 0),
    (b"P5", "pgm", 0),
    (b"P6", "ppm", 0),
    (b".snd", "au", 0),
    (b"ftyp", "mp4", 4),
]
RIFF_FORMS = {b"WAVE": "wav", b"AVI ": "avi", b"WEBP": "webp"}
BMP_HEADERS = (12, 40, 52, 56, 64, 108, 124)
MP4_BOXES = frozenset((b"ftyp", b"moov", b"mdat", b"free", b"skip", b"wide", b"meta", b"uuid", b"moof", b"sidx", b"styp", b"pdin", b"mfra"))
#: Bytes of a sample of an AU file by its encoding, for those of whole bytes.
AU_SAMPLES = {1: 1, 2: 1, 3: 2, 4: 3, 5: 4, 6: 4, 7: 8, 27: 1}
#: What a payload is padded to, and the width of an image that holds it.
UNIT = 576
#: Formats that a text may be stored in.
KINDS = ("wav", "png", "bmp", "pgm", "au")

PNM = re.compile(rb"P[56](?:\s+(?:#[^\r\n]*[\r\n]\s*)*)(\d{1,9})\s+(?:#[^\r\n]*[\r\n]\s*)*(\d{1,9})\s+(?:#[^\r\n]*[\r\n]\s*)*(\d{1,5})\s")
JPEG_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")


@dataclass
class Media:
    kind: str
    offset: int
    length: int


def png_end(data: bytes, at: int) -> int | None:
    """Chunks up to IEND, an IHDR first; checksums are only counted where the chunks are whole."""
    chunks, pos = [], at + 8
    while pos + 12 <= len(data):
        (size,) = struct.unpack_from(">I", data, pos)
        name = data[pos + 4 : pos + 8]
        if pos + 12 + size > len(data) or not name.isalpha() or (not chunks) != (name == b"IHDR") or name == b"IHDR" and size != 13:
            return None
        chunks.append((pos, size))
        pos += 12 + size
        if name == b"IEND":
            good = all(zlib.crc32(memoryview(data)[p + 4 : p + 8 + n]) == struct.unpack_from(">I", data, p + 8 + n)[0] for p, n in chunks)
            return pos if good else None
    return None


class Jpeg:
    """Segments and scans up to the end marker; what follows a marker is followed once, however many images lead there."""

    def __init__(self) -> None:
        self.markers: list[int] | None = None
        self.ends: dict[int, int | None] = {}

    def __call__(self, data: bytes, at: int) -> int | None:
        pos, seen, end = at + 2, [], None
        while pos + 2 <= len(data) and data[pos] == 0xFF:
            if pos in self.ends:
                end = self.ends[pos]
                break
            seen.append(pos)
            marker = data[pos + 1]
            if marker == 0xD9:
                end = pos + 2
                break
            if marker == 0xFF:
                pos += 1
                continue
            if not 0xC0 <= marker <= 0xFE or 0xD0 <= marker <= 0xD8 or pos + 4 > len(data):
                break
            size = struct.unpack_from(">H", data, pos + 2)[0]
            if size < 2:
                break
            pos += 2 + size
            if marker == 0xDA:
                if self.markers is None:
                    self.markers = [m.start() for m in JPEG_MARKER.finditer(data)]
                i = bisect.bisect_left(self.markers, pos)
                if i == len(self.markers):
                    break
                pos = self.markers[i]
        self.ends.update(dict.fromkeys(seen, end))
        # An image has a frame and a scan at least.
        return end if end and end - at > 20 else None


def gif_end(data: bytes, at: int) -> int | None:
    """Colour tables, extensions and images up to the trailer."""
    if at + 13 > len(data):
        return None
    table = lambda flags: 3 << (flags & 7) + 1 if flags & 0x80 else 0
    pos = at + 13 + table(data[at + 10])
    images = 0
    while pos < len(data):
        block = data[pos]
        if block == 0x3B:
            return pos + 1 if images else None
        if block == 0x21:
            pos += 2
        elif block == 0x2C and pos + 10 < len(data):
            images += 1
            pos += 11 + table(data[pos + 9])
        else:
            return None
        while pos < len(data) and data[pos]:
            pos += data[pos] + 1
        pos += 1
    return None


def bmp_end(data: bytes, at: int) -> int | None:
    """A header of a known size whose rows fit in the stated length."""
    if at + 26 > len(data):
        return None
    size, reserved, start, header = struct.unpack_from("<IIII", data, at + 2)
    if reserved or header not in BMP_HEADERS or start < 14 + header or size < start or at + size > len(data):
        return None
    if header == 12:
        width, height, planes, bits, packed = *struct.unpack_from("<HHHH", data, at + 18), 0
    elif at + 34 <= len(data):
        width, height, planes, bits, packed = struct.unpack_from("<iiHHI", data, at + 18)
    else:
        return None
    if planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or width <= 0 or not height:
        return None
    rows = (width * bits + 31) // 32 * 4 * abs(height)
    return at + size if packed in (1, 2) or start + rows <= size else None


def riff_end(data: bytes, at: int) -> int | None:
    """A known form whose chunks fill the stated length."""
    if at + 12 > len(data) or data[at + 8 : at + 12] not in RIFF_FORMS:
        return None
    end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
    pos, names = at + 12, set()
    while pos + 8 <= end <= len(data):
        names.add(data[pos : pos + 4])
        size = struct.unpack_from("<I", data, pos + 4)[0]
        pos += 8 + size + size % 2
    wanted = {b"WAVE": {b"fmt ", b"data"}, b"AVI ": {b"LIST"}, b"WEBP": set()}[data[at + 8 : at + 12]]
    return end if names and pos in (end, end + 1) and end <= len(data) and wanted <= names else None


def pnm_end(data: bytes, at: int) -> int | None:
    """Width, height and greatest value, and as many samples."""
    m = PNM.match(data, at)
    if not m:
        return None
    width, height, most = map(int, m.groups())
    end = m.end() + width * height * (1 + 2 * (data[at + 1] == 0x36)) * (1 + (most > 255))
    return end if width and height and 0 < most < 65536 and end <= len(data) else None


def au_end(data: bytes, at: int) -> int | None:
    """A header with a known encoding, and whole frames of the stated length."""
    if at + 24 > len(data):
        return None
    start, size, encoding, rate, channels = struct.unpack_from(">IIIII", data, at + 4)
    frame = AU_SAMPLES.get(encoding, 0) * channels
    good = 24 <= start <= 1 << 16 and frame and channels <= 64 and 0 < rate <= 1 << 20 and size != 0xFFFFFFFF and size % frame == 0
    return at + start + size if good and at + start + size <= len(data) else None


def mp4_end(data: bytes, at: int) -> int | None:
    """Known boxes one after another, with something to play."""
    pos, names = at, set()
    while at >= 0 and pos + 8 <= len(data) and data[pos + 4 : pos + 8] in MP4_BOXES:
        size = struct.unpack_from(">I", data, pos)[0]
        if size == 1 and pos + 16 <= len(data):
            size = struct.unpack_from(">Q", data, pos + 8)[0]
        if size < 8 or pos + size > len(data):
            return None
        names.add(data[pos + 4 : pos + 8])
        pos += size
    return pos if b"ftyp" in names and names & {b"moov", b"moof", b"mdat"} else None


def automaton() -> ahocorasick.Automaton:
    """The automaton of all signatures, over bytes as Latin-1 characters."""
    found = ahocorasick.Automaton()
    for magic, kind, before in SIGNATURES:
        found.add_word(magic.decode("latin-1"), (kind, len(magic) - 1 + before))
    found.make_automaton()
    return found


def validators() -> dict[str, Callable[[bytes, int], int | None]]:
    """The validator of each signature's format, for one value: the end of what starts at a place, or nothing."""
    return {"png": png_end, "jpeg": Jpeg(), "gif": gif_end, "bmp": bmp_end, "riff": riff_end, "pgm": pnm_end, "ppm": pnm_end, "au": au_end, "mp4": mp4_end}


def find_media(data: bytes, signatures: ahocorasick.Automaton) -> list[Media]:
    """All media of a value that don't lie in other embedded media, in order; one at 0 is the value itself, and is gone into."""
    found: list[Media] = []
    check, free = validators(), 0
    matches = ((last - back, kind) for last, (kind, back) in signatures.iter(data.decode("latin-1")))
    for at, kind in sorted(matches):
        if at < free or not (end := check[kind](data, at)):
            continue
        found.append(Media(RIFF_FORMS[data[at + 8 : at + 12]] if kind == "riff" else kind, at, end - at))
        if at:
            free = end
    return found


MEDIA = "array<struct<kind string, offset long, length long>>"


def sniff(df: DataFrame, id_col: str, data_col: str, declared_col: str, bytes_too: bool = False) -> DataFrame:
    """What each value of a media column is.

    Columns: ``id_col``; ``declared``; ``kind``, by signature and structure, or
    null if the value starts with none of the formats; ``declared_right``;
    ``length`` of that format in the value; ``n_bytes`` of the value;
    ``embedded``, the media elsewhere in it, in order, each with its kind, offset
    and length.  With ``bytes_too`` also the value, as ``data``.

    A null value has no bytes and is nothing, and so is an empty one; a null
    declaration is right for nothing else.  Cut-off media are none.  Whole values
    are read.  Rows that repeat are given each; other columns are ignored.
    """
    kind = df.schema[id_col].dataType
    fields = [(id_col, kind), ("declared", T.StringType()), ("kind", T.StringType()), ("declared_right", T.BooleanType()), ("length", T.LongType()), ("n_bytes", T.LongType()), ("embedded", T._parse_datatype_string(MEDIA))]
    schema = T.StructType([T.StructField(*f) for f in fields + [("data", T.BinaryType())] * bytes_too])
    arrow = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = automaton()
        for batch in (part for whole in batches for part in sliced(whole, 2)):
            out = []
            for own, declared, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), binary(batch.column(2)), strict=True):
                found = find_media(data or b"", signatures)
                top = found[0] if found and found[0].offset == 0 else None
                inner = [vars(m) for m in found if m.offset]
                row = (own, declared, top and top.kind, declared == (top and top.kind), top.length if top else 0, len(data or b""), inner)
                out.append(row + (data,) * bytes_too)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), arrow, strict=True)], names=schema.names)

    columns = [F.col(f"`{id_col}`").alias(id_col), F.col(f"`{declared_col}`").cast("string").alias("its declaration"), F.col(f"`{data_col}`").cast("binary").alias("its data")]
    return df.select(*columns).mapInArrow(run, schema)


def carve(df: DataFrame, id_col: str, data_col: str, declared_col: str) -> DataFrame:
    """The embedded media of each value, one a row: ``id_col``, ``kind``, ``offset``, ``length`` and their bytes as ``media``."""
    found = sniff(df, id_col, data_col, declared_col, bytes_too=True)
    each = found.select(F.col(f"`{id_col}`"), "data", F.explode("embedded").alias("m"))
    part = F.substring(F.col("data"), (F.col("m.offset") + 1).cast("int"), F.col("m.length").cast("int"))
    return each.select(F.col(f"`{id_col}`"), "m.kind", "m.offset", "m.length", part.alias("media"))


def png(samples: bytes, width: int) -> bytes:
    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    rows = np.frombuffer(samples, np.uint8).reshape(-1, width)
    plain = np.hstack([np.zeros((len(rows), 1), np.uint8), rows]).tobytes()
    header = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(plain, 1)) + chunk(b"IEND", b"")


def bmp(samples: bytes, width: int) -> bytes:
    rows = np.frombuffer(samples, np.uint8).reshape(-1, width)
    padded = np.pad(rows, ((0, 0), (0, -width % 4)))[::-1].tobytes()
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256))
    start = 54 + len(palette)
    header = struct.pack("<2sIII", b"BM", start + len(padded), 0, start) + struct.pack("<IiiHHIIiiII", 40, width, len(rows), 1, 8, 0, len(padded), 2835, 2835, 256, 0)
    return header + palette + padded


def encode(kind: str, samples: bytes, width: int = UNIT) -> bytes:
    """Samples of 8 bits as a media file: one channel at 8 kHz, or grey rows of ``width``."""
    if kind == "wav":
        body = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 8000, 1, 8) + b"data" + struct.pack("<I", len(samples)) + samples + b"\0" * (len(samples) % 2)
        return b"RIFF" + struct.pack("<I", len(body)) + body
    if kind == "au":
        return b".snd" + struct.pack(">IIIII", 28, len(samples), 2, 8000, 1) + b"\0\0\0\0" + samples
    if kind == "pgm":
        return b"P5\n%d %d\n255\n" % (width, len(samples) // width) + samples
    return {"png": png, "bmp": bmp}[kind](samples, width)


def unfiltered(data: np.ndarray, step: int) -> np.ndarray:
    """The rows of a PNG without their filters; ``step`` bytes a pixel."""
    out = np.zeros((len(data), data.shape[1] - 1), np.uint8)
    above = np.zeros(out.shape[1], np.uint8)
    for i, (kind, row) in enumerate(zip(data[:, 0].tolist(), data[:, 1:], strict=True)):
        if kind == 1:
            row = np.cumsum(row.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            row = row + above
        elif kind in (3, 4):
            now, up = row.tolist(), above.tolist()
            for k in range(len(now)):
                a, b, c = (now[k - step], up[k], up[k - step]) if k >= step else (0, up[k], 0)
                near = (a + b) // 2 if kind == 3 else min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
                now[k] = (now[k] + near) & 255
            row = np.array(now, np.uint8)
        out[i] = above = row
    return out


def decode(kind: str, data: bytes) -> bytes:
    """The samples of 8 bits of a valid media file; other depths and compressed ones raise a ``ValueError``."""
    if kind == "wav":
        pos, found = 12, {}
        while pos + 8 <= len(data):
            size = struct.unpack_from("<I", data, pos + 4)[0]
            found.setdefault(data[pos : pos + 4], data[pos + 8 : pos + 8 + size])
            pos += 8 + size + size % 2
        if struct.unpack_from("<H", found[b"fmt "])[0] == 1 and struct.unpack_from("<H", found[b"fmt "], 14)[0] == 8:
            return found[b"data"]
    elif kind == "au":
        start, size, encoding = struct.unpack_from(">III", data, 4)
        if AU_SAMPLES.get(encoding) == 1:
            return data[start : start + size]
    elif kind in ("pgm", "ppm"):
        m = PNM.match(data)
        if int(m[3]) < 256:
            return data[m.end() : pnm_end(data, 0)]
    elif kind == "bmp":
        _, _, start, header = struct.unpack_from("<IIII", data, 2)
        width, height, _, bits, packed = struct.unpack_from("<iiHHI", data, 18)
        if header > 12 and bits == 8 and not packed:
            stride = -(-width // 4) * 4
            rows = np.frombuffer(data, np.uint8, stride * abs(height), start).reshape(-1, stride)[:, :width]
            return (rows[::-1] if height > 0 else rows).tobytes()
    elif kind == "png":
        width, height, depth, colour, _, _, woven = struct.unpack_from(">IIBBBBB", data, 16)
        step = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour, 0)
        if depth == 8 and step and not woven:
            pos, packed = 8, []
            while (name := data[pos + 4 : pos + 8]) != b"IEND":
                size = struct.unpack_from(">I", data, pos)[0]
                if name == b"IDAT":
                    packed.append(data[pos + 8 : pos + 8 + size])
                pos += 12 + size
            rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, 1 + width * step)
            return unfiltered(rows, step).tobytes() if rows[:, 0].any() else rows[:, 1:].tobytes()
    raise ValueError(f"no samples of 8 bits in this {kind}")


def payload_of(text: bytes) -> bytes:
    """The bytes of a text with 255s up to a positive multiple of ``UNIT``."""
    return text + b"\xff" * (-len(text) % UNIT if text else UNIT)


def store_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each text's payload as media: ``id_col``, ``n_bytes``, ``declared`` and ``media``.

    The format is chosen by the payload's checksum, and so is the declared one,
    which is another in four of five cases: equal texts are stored alike.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("n_bytes", T.LongType()), T.StructField("declared", T.StringType()), T.StructField("media", T.BinaryType())])
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in sliced(whole, 1)):
            sizes, declared, media = [], [], []
            for text in binary(batch.column(1)):
                payload = payload_of(text or b"")
                check = zlib.crc32(payload)
                sizes.append(len(text or b""))
                declared.append(KINDS[(check >> 8) % len(KINDS)])
                media.append(encode(KINDS[check % len(KINDS)], payload))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(id_type), pa.array(sizes, pa.int64()), pa.array(declared), pa.array(media, pa.binary())], names=schema.names)

    return docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("its text")).mapInArrow(run, schema)


def describe(samples: bytes) -> str:
    """Features of samples: their number, mean and deviation, entropy in bits, and the share of equal neighbours."""
    x = np.frombuffer(samples, np.uint8)
    n = np.bincount(x, minlength=256)
    share = n[n > 0] / len(x)
    same = float((x[1:] == x[:-1]).mean())
    return f"samples={len(x)} mean={x.mean():.4f} std={x.std():.4f} entropy={-(share * np.log2(share)).sum():.4f} same={same:.4f}"


def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts stored as media, read back, recognised by signature and structure, and described.

    Columns: ``id_col``, ``n_bytes`` of the text, ``payload_bytes``,
    ``payload_sha256`` and ``tail_crc32`` of the samples read back,
    ``media_bytes`` and ``media_sha256`` of the file, ``feature`` (kind, declared
    kind, embedded media and ``describe``), ``kind`` and ``declared``.

    A null or empty text is one unit of padding.  Texts are stored whole, however
    long, repeated rows and null ids each; other columns are ignored.  Media that
    can't be recognised or read raise an error.
    """
    stored = materialize(store_texts(docs, id_col, text_col), f"{workspace(docs.sparkSession, 'media')}/stored")
    own = F.struct(F.col(f"`{id_col}`").alias("id"), "n_bytes").alias("own")
    found = sniff(stored.select(own, "declared", "media"), "own", "media", "declared", bytes_too=True)
    names = [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "kind", "declared"]
    kind = docs.schema[id_col].dataType
    types = [kind, T.LongType(), T.LongType(), T.StringType(), T.LongType(), T.LongType(), *[T.StringType()] * 4]
    schema = T.StructType([T.StructField(*f) for f in zip(names, types, strict=True)])
    arrow = [to_arrow_type(t) for t in types]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in sliced(whole, 5)):
            out = []
            for own, size, declared, kind, inner, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                samples = decode(kind, data)
                feature = f"kind={kind} declared={declared} embedded={'+'.join(m['kind'] for m in inner) or 0} {describe(samples)}"
                out.append((own, size, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature, kind, declared))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), arrow, strict=True)], names=names)

    return found.select("own.id", "own.n_bytes", "declared", "kind", "embedded", "data").mapInArrow(run, schema)
