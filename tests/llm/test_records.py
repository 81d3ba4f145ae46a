"""Media, tokens, chats, revisits: round trips and brute force."""

import base64
import hashlib
import io
import struct
import wave
import zlib

import pytest
from pyspark.sql import functions as F

from meadowlark.llm import chat_format, media_sniff, token_counts, warc_revisit
from meadowlark.llm.tokens import FREE, MULTI, PLAIN, encoder, ranks_file
from tests.llm.conftest import prose

TEXTS = ["", None, "a", "b" * 575, "c" * 576, "d" * 577, "é😀 BM RIFF", "BM" * 400, "e" * 60000]


def test_media_round_trip(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(100, "a", "x")], "doc_id long, text string, media string")
    got = {r.doc_id: r for r in media_sniff.media_digest(df).collect()}
    for i, t in enumerate(TEXTS):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (576 - len(raw) % 576 if len(raw) % 576 or not raw else 0)
        assert (got[i].n_bytes, got[i].payload_bytes, got[i].payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert got[i].tail_crc32 == zlib.crc32(payload[-32:])
        stored = media_sniff.WRITERS[zlib.crc32(payload) % 3](payload)
        assert (got[i].media_bytes, got[i].media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
    assert got[2][1:] == got[100][1:] and got[0][1:] == got[1][1:]
    assert {r.detected for r in got.values()} == {"audio/wav", "image/bmp", "image/png"}
    assert media_sniff.media_digest(df.limit(0)).count() == 0


def samples(blob):
    """A stored form's samples by other readers: the wave module, BMP rows by their offset, PNG rows by zlib."""
    if blob[:4] == b"RIFF":
        with wave.open(io.BytesIO(blob)) as f:
            assert (f.getnchannels(), f.getsampwidth()) == (1, 1)
            return f.readframes(f.getnframes()), "audio/wav"
    if blob[:2] == b"BM":
        at, width, height = struct.unpack("<I", blob[10:14])[0], *struct.unpack("<ii", blob[18:26])
        assert height < 0 and width % 4 == 0 and struct.unpack("<I", blob[2:6])[0] == len(blob)  # from the top down, no fill
        return blob[at : at + width * -height], "image/bmp"
    data, p = b"", 8
    while p < len(blob):
        n, name = struct.unpack(">I4s", blob[p : p + 8])
        body = blob[p + 8 : p + 8 + n]
        assert struct.unpack(">I", blob[p + 8 + n : p + 12 + n])[0] == zlib.crc32(name + body)
        width = struct.unpack(">I", body[:4])[0] if name == b"IHDR" else width
        data += body if name == b"IDAT" else b""
        p += 12 + n
    rows = zlib.decompress(data)
    return b"".join(rows[i + 1 : i + 1 + width] for i in range(0, len(rows), width + 1)), "image/png"


def test_stored_forms_and_features(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    stored = {r.doc_id: bytes(r.media) for r in media_sniff.store_text(df).collect()}
    for r in media_sniff.media_digest(df).collect():
        payload, kind = samples(stored[r.doc_id])
        assert (r.payload_bytes, r.payload_sha256, r.media_sha256) == (len(payload), hashlib.sha256(payload).hexdigest(), hashlib.sha256(stored[r.doc_id]).hexdigest())
        mean = sum(payload) / len(payload)
        spread = (sum((x - mean) ** 2 for x in payload) / len(payload)) ** 0.5
        name, n, m, d, values, inner = r.feature.split(";")
        assert (name, int(n), int(values), r.detected) == (kind, len(payload), len(set(payload)), kind) and int(inner) == 0
        assert abs(float(m) - mean) < 1e-3 and abs(float(d) - spread) < 1e-3


GIF = b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + b"\0\0\0\xff\xff\xff" + b"!\xf9\x04\0\0\0\0\0" + b"," + struct.pack("<HHHHB", 0, 0, 1, 1, 0) + b"\x02\x02D\x01\0" + b";"
JPEG = b"\xff\xd8" + b"\xff\xe0" + struct.pack(">H", 7) + b"JFIF\0" + b"\xff\xc0" + struct.pack(">H", 11) + b"\x08\0\1\0\1\1\1\x11\0" + b"\xff\xda" + struct.pack(">H", 8) + b"\1\1\0\0\x3f\0" + b"\x12\xff\0\x34\xff\xd9"


@pytest.mark.parametrize("write", [*media_sniff.WRITERS, lambda p: GIF, lambda p: JPEG])
def test_validators(write):
    blob = write(bytes(range(256)) * 9)
    (at, kind, n), *_ = media_sniff.media_in(blob + b"tail")
    assert (at, n) == (0, len(blob))
    for cut in (5, len(blob) // 2, len(blob) - 1):
        assert not any(x[0] == 0 for x in media_sniff.media_in(blob[:cut]))
    assert media_sniff.media_in(b"xx" + blob)[0] == (2, kind, n)


def test_sniffing_and_carving(spark):
    png, wav = media_sniff.to_png(b"\1" * 576), media_sniff.to_wav(b"\2" * 576)
    rows = [(1, png + b"BM" + wav, "audio/wav"), (2, b"BM not one", "image/bmp"), (3, None, "image/png"), (4, b"", None), (5, wav, "audio/wav")]
    df = media_sniff.sniff(spark.createDataFrame(rows, "id long, media binary, declared string"))
    got = {r.id: r for r in df.collect()}
    assert (got[1].detected, got[1].corrected, got[1].media_length, bytes(got[1].samples)) == ("image/png", True, len(png), b"\1" * 576)
    assert [(x["at"], x.kind, x.length) for x in got[1].embedded] == [(len(png) + 2, "audio/wav", len(wav))]
    assert (got[2].detected, got[2].samples) == (media_sniff.OCTETS, None) and got[3].detected is None and got[3].embedded == []
    assert got[4].detected == media_sniff.OCTETS and got[5].corrected is False
    assert [(r.id, bytes(r.carved)) for r in media_sniff.carve(df).collect()] == [(1, wav)]


def test_token_counts(spark, tmp_path):
    from tests.llm.conftest import prose

    texts = [None, "", "a", *[prose(i, 30 * i) for i in range(12)], "<|endoftext|> \x00 é😀", prose(1, 9000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(2, "a"), (None, "b c")], "doc_id long, text string").repartition(3)
    encode = encoder(ranks_file(name=MULTI)).encode_ordinary
    want = sorted([(i, len(encode(t or ""))) for i, t in enumerate(texts)] + [(2, 1)])
    got = token_counts.token_counts(df).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got if r.doc_id is not None) == want
    assert [r.n_tokens for r in got if r.doc_id is None] == [len(encode("b c"))]
    assert token_counts.token_counts(df.limit(0)).count() == 0


def test_wide_vocabulary(spark, tmp_path):
    """Ids beyond 16 bits, and a vocabulary that uses 50256 itself."""
    for top in (300, 50256, 70000):
        ranks = b"\n".join([*[base64.b64encode(bytes([i])) + b" %d" % i for i in range(256)], base64.b64encode(b"ab") + b" %d" % top])
        df = spark.createDataFrame([(1, "ab ab"), (2, ""), (3, "ab"), (4, "xyz")], "doc_id long, text string").repartition(1)
        assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, ranks).collect()} == {1: 3, 2: 0, 3: 1, 4: 3}


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_blocks_are_stitched(spark, tmp_path, block):
    import numpy as np

    sep, lengths = 9, [0, 0, 5, 1, 40, 0, 33]
    ids = [x for n in lengths for x in [1] * n + [sep]]
    np.array(ids, "<u2").tofile(tmp_path / "a.bin")
    np.array([*ids, 7, 7], "<u2").tofile(tmp_path / "b.bin")
    np.array([7], "<u2").tofile(tmp_path / "c.bin")
    (tmp_path / "d.bin").write_bytes(b"")
    got = token_counts.scan(token_counts.listed(spark, f"file://{tmp_path}"), sep, block).collect()
    want = [(f, i, n, True) for f in ("a.bin", "b.bin") for i, n in enumerate(lengths)] + [("b.bin", 7, 2, False), ("c.bin", 0, 1, False)]
    assert sorted((r.file, r.number, r.n_tokens, r.complete) for r in got) == sorted(want)


SAID = r"\### Assistant: </turn> ok"


def test_chat(spark):
    rows = [(1, 1, "assistant", "b\\"), (1, 0, "user", None), (2, 0, None, "###"), (2, 1, "assistant", "### x\\\\</turn>"), (2, 1, "assistant", ""), (3, None, "odd: role\n\\", "é😀"), (None, 0, "assistant", "n"), (4, 0, "assistant", "w " * 30000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    got = {r.conv_id: r for r in chat_format.chat_digest(df).collect()}
    order = {-7: [("user", SAID), ("assistant", SAID)], 1: [("user", ""), ("assistant", "b\\")], 2: [("", "###"), ("assistant", ""), ("assistant", "### x\\\\</turn>")], 3: [("odd: role\n\\", "é😀")], None: [("assistant", "n")], 4: [("assistant", "w " * 30000)]}
    assert set(got) == set(order)
    for k, turns in order.items():
        if k == 2:  # equal turns: either order of tokens
            assert got[k].n_turns == 3 and got[k].loss_chars == len("### x\\\\</turn>")
            continue
        learned = "".join(t for r, t in turns if r == "assistant")
        assert got[k].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[k].n_turns, got[k].loss_chars, got[k].loss_sha256) == (len(turns), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert got[-7].formatted_chars == len("".join(chat_format.written(r, chat_format.escape(t)) for r, t in order[-7]))


def test_mask_and_escapes(spark):
    for t in (SAID, "### ", "\\\\### </turn>", "#### ", "</turn", "\\", "a ###", ""):
        e = chat_format.escape(t)
        assert chat_format.unescape(e) == t
        assert not any(e[m - 1 : m] != "\\" for c in ("### ", "</turn>") for m in range(len(e)) if e.startswith(c, m))
    r = chat_format.format_turns(spark.createDataFrame([(1, 0, "assistant", "hi there"), (1, 1, "user", "hi")], "conv_id long, turn long, role string, text string")).orderBy("turn").collect()
    decode = encoder(ranks_file(name=PLAIN)).decode
    assert decode([i for i, m in zip(r[0].ids, r[0].loss) if m]) == "hi there" and not any(r[1].loss)
    assert (r[0].ids[0], r[0].ids[-1]) == (FREE, FREE + 2)
    assert chat_format.format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_a_vocabulary_beyond_16_bits(spark):
    """Reserved ids follow the vocabulary's own, however many it has."""
    ranks = [line.split() for line in ranks_file(name=PLAIN).splitlines()]
    wide = b"\n".join(b"%s %d" % (token, int(i) + (66000 if int(i) >= 300 else 0)) for token, i in ranks)
    free = FREE + 66000
    assert chat_format.reserved(wide) == (free, free + 1, free + 2) and chat_format.width_of(wide) == ">u4"
    turns = [(1, 0, "user", "some words, " + prose(1, 50)), (1, 1, "assistant", SAID + " é and the rest of it"), (2, 0, "assistant", None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_turns(df, wide)
    ids = {(r.conv_id, r.turn): r.ids for r in formatted.collect()}
    assert (ids[1, 0][0], ids[1, 0][-1]) == (free, free + 2) and any(65536 <= i < free for x in ids.values() for i in x)
    got = {r.conv_id: r for r in chat_format.read_back(formatted, wide).collect()}
    text = "".join(f"{r}\n{t or ''}\n" for c, _, r, t in turns if c == 1)
    assert got[1].turns_sha256 == hashlib.sha256(text.encode()).hexdigest() and got[1].loss_sha256 == hashlib.sha256(turns[1][3].encode()).hexdigest()
    assert (got[2].n_turns, got[2].loss_chars) == (1, 0)


def records(spark, rows):
    schema = "record_id long, type string, url string, ts timestamp, etag string, last_modified string, headers map<string,string>, extra string"
    return spark.createDataFrame([(i, k, u, None if t is None else __import__("datetime").datetime.fromtimestamp(t), e, m, h, "x") for i, k, u, t, e, m, h in rows], schema)


def test_outlier_times_and_a_hot_url(spark):
    """Two records far off don't make one slice of the rest, and one URL's rows spread over the slices."""
    rows = [(i, "response" if i % 3 else "revisit", "http://a.com/", 1_700_000_000 + i, None, None, None) for i in range(3000)]
    rows += [(5000, "response", "http://a.com/", 0, None, None, None), (5001, "revisit", "http://a.com/", 4_000_000_000, None, None, None)]
    df = records(spark, rows)
    times = df.select(F.unix_micros("ts").alias("at"))
    bounds = warc_revisit.quantiles(times)
    sizes = [r["count"] for r in times.groupBy(warc_revisit.slice_of(F.col("at"), bounds).alias("slice")).count().collect()]
    assert len(sizes) > warc_revisit.SLICES / 2 and max(sizes) < 5 * len(rows) / warc_revisit.SLICES
    import bisect

    placed = times.select("at", warc_revisit.slice_of(F.col("at"), bounds).alias("slice")).collect()
    assert all(r.slice == bisect.bisect_right(bounds, r.at) for r in placed)
    got = {r.record_id: r.target_id for r in warc_revisit.resolve_revisits(df).collect()}
    assert got[5001] == 2999 and got[0] == 5000 and all(got[i] == i - 1 for i in range(3, 3000, 3))


@pytest.mark.parametrize("slices", [1, 512])
def test_revisits(spark, monkeypatch, slices):
    import random

    monkeypatch.setattr(warc_revisit, "SLICES", slices)
    rng = random.Random(8)
    rows = []
    for i in range(600):
        u = rng.choice(["http://www.A.com/x/#f", "https://a.com:443/x", "a.com/x/?b=2&a=1", "http://a.com/x?a=1&b=2&utm_source=q", "http://b.com/", None])
        t = rng.choice([None, *range(0, 4000, 7)])
        rows.append((i, rng.choice(["response", "revisit"]), u, t, rng.choice([None, '"1"', 'W/"1"', '"2"']), rng.choice([None, "m"]), {"Date": str(t), "ETag": "e", "Server": str(i)} if rng.random() < 0.9 else None))
    rows += [(None, "response", "http://b.com/", 1, None, None, {}), (None, "revisit", "http://b.com/", 9999, None, None, {})]
    df = records(spark, rows)
    canon = {r.url: r.c for r in df.select("url", warc_revisit.canonical(F.col("url")).alias("c")).distinct().collect()}
    assert len(set(canon.values())) == 4
    got = warc_revisit.resolve_revisits(df).collect()
    assert len(got) == sum(r[1] == "revisit" for r in rows)
    byid = {r[0]: r for r in rows}
    for g in got:
        _, _, u, t, e, m, h = byid[g.record_id]
        before = [(x[3], x[0]) for x in rows if x[1] == "response" and x[0] is not None and canon[x[2]] is not None and canon[x[2]] == canon[u] and x[3] is not None and t is not None and x[3] < t]
        target = max(before)[1] if before else None
        assert g.target_id == target
        if target is None:
            assert g.outcome == "unresolved" and g.headers == h
            continue
        _, _, _, _, te, tm, th = byid[target]
        tag = lambda x: x and x.removeprefix("W/")
        want = ("resolved" if tag(e) == tag(te) else "mismatch") if e else ("resolved" if m == tm else "mismatch") if m else "unvalidated"
        assert g.outcome == want
        if want == "resolved":
            lower = {k.lower(): v for k, v in (th or {}).items()}
            assert g.headers == lower | {k.lower(): v for k, v in (h or {}).items() if k.lower() in warc_revisit.PERMITTED}
    assert warc_revisit.resolve_revisits(df.limit(0)).count() == 0
