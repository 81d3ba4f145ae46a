"""Media columns: signature sniffing.

An Aho-Corasick automaton finds every magic number of a blob in one pass; a validator of the
format then confirms the structure and works out the length. What holds at offset 0 is the blob's
true type, whatever was declared; confirmed media further in are carved.

Nulls: a null blob gives null type, length, samples and feature and an empty ``embedded``. A blob
without any confirmed medium at 0 gets the type ``application/octet-stream`` and no samples. Empty
blobs count as such. Rows are handled one by one: repeated rows give repeated results, an empty
table gives an empty one, and columns of the input that have the name of a result column give way. A
blob or text is held whole, with its stored form and samples: some five times its length for a very long one.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meadowlark.llm.common import add_by_rows, col

OCTETS = "application/octet-stream"
#: The formats' magic numbers.
MAGIC = {
    b"RIFF": "audio/wav",
    b"BM": "image/bmp",
    b"\x89PNG\r\n\x1a\n": "image/png",
    b"GIF87a": "image/gif",
    b"GIF89a": "image/gif",
    b"\xff\xd8\xff": "image/jpeg",
}
UNIT = 576
EMBEDDED = T.ArrayType(T.StructType([T.StructField("at", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("length", T.LongType())]))


# ---- validators: the length of a medium that starts at `at`, or None ---------------------------


def wav_length(b: bytes, at: int) -> int | None:
    if b[at + 8 : at + 12] != b"WAVE" or at + 12 > len(b):
        return None
    size = struct.unpack_from("<I", b, at + 4)[0] + 8
    if at + size > len(b):
        return None
    p, seen = at + 12, set()
    while p + 8 <= at + size:
        name, n = struct.unpack_from("<4sI", b, p)
        seen.add(name)
        p += 8 + n + (n & 1)
    return size if p == at + size and {b"fmt ", b"data"} <= seen else None


def bmp_length(b: bytes, at: int) -> int | None:
    if at + 54 > len(b):
        return None
    size, zero, offset, header, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", b, at + 2)
    if zero or header != 40 or planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or width <= 0 or not height:
        return None
    return size if size == offset + (width * bits + 31) // 32 * 4 * abs(height) and at + size <= len(b) else None


def png_length(b: bytes, at: int) -> int | None:
    p, first = at + 8, True
    while p + 12 <= len(b):
        n, name = struct.unpack_from(">I4s", b, p)
        if p + 12 + n > len(b) or first and (name != b"IHDR" or n != 13):
            return None
        if struct.unpack_from(">I", b, p + 8 + n)[0] != zlib.crc32(b[p + 4 : p + 8 + n]):
            return None
        p, first = p + 12 + n, False
        if name == b"IEND":
            return p - at
    return None


def gif_length(b: bytes, at: int) -> int | None:
    def colours(flags: int) -> int:
        return 3 << (flags & 7) + 1 if flags & 128 else 0

    def after_blocks(p: int) -> int | None:
        while p < len(b):
            if not b[p]:
                return p + 1
            p += 1 + b[p]
        return None

    if at + 13 > len(b):
        return None
    p: int | None = at + 13 + colours(b[at + 10])
    images = 0
    while p is not None and p < len(b):
        if b[p] == 0x3B:
            return p + 1 - at if images else None
        if b[p] == 0x21:
            p = after_blocks(p + 2)
        elif b[p] == 0x2C and p + 11 <= len(b):
            images += 1
            p = after_blocks(p + 11 + colours(b[p + 9]))
        else:
            return None
    return None


def jpeg_length(b: bytes, at: int) -> int | None:
    p, frame = at + 2, False
    while p + 4 <= len(b) and b[p] == 0xFF:
        mark, n = b[p + 1], struct.unpack_from(">H", b, p + 2)[0]
        if n < 2 or mark < 0xC0:
            return None
        frame |= 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC)
        p += 2 + n
        if mark == 0xDA:
            while (p := b.find(b"\xff", p)) >= 0 and p + 1 < len(b) and (not b[p + 1] or 0xD0 <= b[p + 1] <= 0xD7):
                p += 2
            if p < 0:
                return None
            if b[p + 1 : p + 2] == b"\xd9":
                return p + 2 - at if frame else None
    return None


LENGTH: dict[str, Callable[[bytes, int], int | None]] = {"audio/wav": wav_length, "image/bmp": bmp_length, "image/png": png_length, "image/gif": gif_length, "image/jpeg": jpeg_length}


@functools.cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for magic, kind in MAGIC.items():
        found.add_word(magic.decode("latin-1"), (len(magic), kind))
    found.make_automaton()
    return found


def media_in(blob: bytes) -> list[tuple[int, str, int]]:
    """(offset, type, length) of each confirmed medium, outer ones before what they hold."""
    hits = sorted((end + 1 - n, kind) for end, (n, kind) in automaton().iter(blob.decode("latin-1")))
    return [(at, kind, n) for at, kind in hits if (n := LENGTH[kind](blob, at)) is not None]


# ---- storing bytes as samples, reading them back ------------------------------------------------


def to_wav(samples: bytes) -> bytes:
    body = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 8000, 1, 8) + b"data" + struct.pack("<I", len(samples)) + samples + b"\0" * (len(samples) & 1)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def to_bmp(samples: bytes, width: int = 24) -> bytes:
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256))
    head = struct.pack("<IiiHHIIiiII", 40, width, -(len(samples) // width), 1, 8, 0, len(samples), 2835, 2835, 256, 0)
    return b"BM" + struct.pack("<III", 54 + len(palette) + len(samples), 0, 54 + len(palette)) + head + palette + samples


def to_png(samples: bytes, width: int = 24) -> bytes:
    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    rows = b"".join(b"\0" + samples[i : i + width] for i in range(0, len(samples), width))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, len(samples) // width, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 1)) + chunk(b"IEND", b"")


WRITERS = [to_wav, to_bmp, to_png]


def samples_of(blob: bytes, kind: str) -> bytes | None:
    """The 8-bit samples of a stored medium; None for types or depths that this module doesn't write."""
    if kind == "audio/wav":
        p = 12
        while p + 8 <= len(blob):
            name, n = struct.unpack_from("<4sI", blob, p)
            if name == b"data":
                return blob[p + 8 : p + 8 + n]
            p += 8 + n + (n & 1)
    if kind == "image/bmp":
        size, _, offset, _, width, height, _, bits = struct.unpack_from("<IIIIiiHH", blob, 2)
        return blob[offset:size] if bits == 8 and width % 4 == 0 and height < 0 else None
    if kind == "image/png":
        p, data, width = 8, b"", 0
        while p + 12 <= len(blob):
            n, name = struct.unpack_from(">I4s", blob, p)
            if name == b"IHDR":
                width, _, bits, colour = struct.unpack_from(">IIBB", blob, p + 8)
                if (bits, colour) != (8, 0):
                    return None
            data += blob[p + 8 : p + 8 + n] if name == b"IDAT" else b""
            p += 12 + n
        rows = zlib.decompress(data)
        if any(rows[:: width + 1]):  # filtered rows
            return None
        return b"".join(rows[i + 1 : i + 1 + width] for i in range(0, len(rows), width + 1))
    return None


def padded(payload: bytes) -> bytes:
    return payload + b"\xff" * (-len(payload) % UNIT if payload else UNIT)


def store_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_bytes``, ``declared`` and ``media``: the text's UTF-8 bytes (null: none), filled up
    with 255 to a positive multiple of 576, as the samples of a WAV, BMP or PNG, picked by the
    payload's checksum. ``declared`` always says WAV, so two thirds are wrong."""

    def rows(texts):
        made = []
        for t in texts:
            raw = (t or "").encode("utf-8", "surrogatepass")
            payload = padded(raw)
            made.append((len(raw), "audio/wav", WRITERS[zlib.crc32(payload) % len(WRITERS)](payload)))
        return zip(*made, strict=True) if made else ([], [], [])

    return add_by_rows(docs, [text], [T.StructField("n_bytes", T.LongType()), T.StructField("declared", T.StringType()), T.StructField("media", T.BinaryType())], lambda t: [list(x) for x in rows(t)])


def sniff(df: DataFrame, media: str = "media", declared: str = "declared") -> DataFrame:
    """Adds ``detected`` (the confirmed type at offset 0), ``corrected`` (it isn't the declared one),
    ``media_length``, ``embedded`` (confirmed media further in), ``samples`` (the stored bytes, read
    back by the detected type) and ``feature`` (a digest: type, counts, mean and spread of samples)."""
    import numpy as np

    def one(blob: bytes | None, said: str | None):
        if blob is None:
            return None, None, None, [], None, None
        found = media_in(blob)
        kind, length = next(((k, n) for at, k, n in found if at == 0), (OCTETS, len(blob)))
        inner = [{"at": at, "kind": k, "length": n} for at, k, n in found if at > 0]
        samples = samples_of(blob[:length], kind)
        values = np.frombuffer(samples or b"", np.uint8)
        spread = f"{values.mean():.4f};{values.std():.4f};{len(np.unique(values))}" if len(values) else "-;-;0"
        return kind, kind != said, length, inner, samples, f"{kind};{len(values)};{spread};{len(inner)}"

    fields = [T.StructField("detected", T.StringType()), T.StructField("corrected", T.BooleanType()), T.StructField("media_length", T.LongType()), T.StructField("embedded", EMBEDDED), T.StructField("samples", T.BinaryType()), T.StructField("feature", T.StringType())]
    return add_by_rows(df, [media, declared], fields, lambda blobs, said: [list(x) for x in zip(*map(one, blobs, said), strict=True)] or [[] for _ in fields])


def carve(df: DataFrame, media: str = "media") -> DataFrame:
    """One row for each embedded medium of sniffed rows, with its bytes in ``carved``."""
    keep = [c for c in df.columns if c not in ("embedded", "samples", "found", "carved")]
    found = df.select(*map(col, keep), F.explode("embedded").alias("found"))
    return found.withColumn("carved", F.substring(col(media), F.col("found.at").cast("int") + 1, F.col("found.length").cast("int")))


def media_digest(docs: DataFrame) -> DataFrame:
    """The query's columns, from what was stored and read back."""
    read = sniff(store_text(docs.select("doc_id", "text")).drop("text"))
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length("samples").cast("long").alias("payload_bytes"),
        F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.substring("samples", -32, 32)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        "detected",
        "corrected",
    )
