import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from lakeops.llm.gif import BLOCK, canvases, decode_gif, encode_gif, gif_frames, histogram, lzw_decode, lzw_encode, payload_digests, read_payload


def plain_decode(stream, bits):
    """A code at a time, as the format describes it."""
    clear, value, at, out = 1 << bits, int.from_bytes(stream, "little"), 0, bytearray()
    table, width, before = [], bits + 1, None
    while True:
        code = value >> at & ((1 << width) - 1)
        at += width
        if code == clear:
            table, width, before = [bytes((i,)) for i in range(clear)] + [b"", b""], bits + 1, None
            continue
        if code == clear + 1:
            return bytes(out)
        now = table[code] if code < len(table) else before + before[:1]
        if before is not None and len(table) < 4096:
            table.append(before + now[:1])
            if len(table) == 1 << width and width < 12:
                width += 1
        out += now
        before = now


def test_code_streams_round_trip_and_follow_the_format():
    r = random.Random(1)
    for n in (0, 1, 2, 3, 100, 5000, 70000):
        for letters in (1, 2, 7, 256):
            data = bytes(r.randrange(letters) for _ in range(n))
            stream = lzw_encode(data)
            assert lzw_decode(stream, 8, n) == data == plain_decode(stream, 8)
    for bits in (2, 3, 4):
        data = bytes(r.randrange(1 << bits) for _ in range(3000))
        assert lzw_decode(lzw_encode(data, bits), bits, 3000) == data == plain_decode(lzw_encode(data, bits), bits)


def test_a_full_table_without_a_clear_code_stays_as_it_is():
    r = random.Random(2)
    codes, width, out = [], [], 256
    for k in range(6000):
        codes.append(r.randrange(256) if k < 3 or r.random() < 0.5 else r.randrange(258, min(258 + k - 1, 4096)))
        width.append(min(12, (258 + max(0, k - 1)).bit_length()))
    value = at = 0
    for c, w in [(256, 9), *zip(codes, width), (257, 12)]:
        value |= c << at
        at += w
    stream = value.to_bytes(-(-at // 8), "little")
    want = plain_decode(stream, 8)
    assert lzw_decode(stream, 8, 10**9) == want and len(want) > 6000


def test_broken_files_raise():
    good = encode_gif(bytes(range(64)) * 2)
    for bad in (b"", b"GIF", good[:9], good[:-30], b"PNG" + good[3:], good[:-1] + b"\x99"):
        with pytest.raises(ValueError):
            decode_gif(bad)


def made(frames, size=(4, 4)):
    """(left, top, width, height, disposal, transparent, delay, interlaced, indexes) frames over a four-colour palette."""
    out = [b"GIF89a", struct.pack("<HHBBB", *size, 0xF1, 0, 0), bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])]
    for left, top, w, h, disposal, clear, delay, interlaced, indexes in frames:
        flags = disposal << 2 | (clear is not None)
        out += [b"!\xf9\x04", struct.pack("<BHBB", flags, delay, clear or 0, 0), b",", struct.pack("<HHHHB", left, top, w, h, 0x40 if interlaced else 0), b"\x02"]
        data = lzw_encode(bytes(indexes), 2)
        out += [bytes((len(data),)), data, b"\0"]
    return b"".join([*out, b"!\xfe\x03abc\0", b";"])


def test_disposal_transparency_and_interlacing():
    gif = decode_gif(made([
        (0, 0, 4, 4, 1, None, 5, False, [1] * 16),
        (1, 1, 2, 2, 2, 3, 7, False, [2, 3, 3, 2]),
        (0, 0, 2, 2, 3, None, 1, False, [3] * 4),
        (0, 0, 1, 4, 1, None, 0, True, [0, 2, 1, 3]),
    ]))
    shown = [c for c in canvases(gif)]
    red, green, blue, none = [255, 0, 0, 255], [0, 255, 0, 255], [0, 0, 255, 255], [0, 0, 0, 0]
    assert shown[1][1, 1].tolist() == green and shown[1][1, 2].tolist() == red
    assert shown[2][1, 2].tolist() == none and shown[2][2, 1].tolist() == none and shown[2][0, 0].tolist() == blue and shown[2][1, 1].tolist() == blue
    assert shown[3][:, 0].tolist() == [[0, 0, 0, 255], red, green, blue] and shown[3][0, 1].tolist() == red and shown[3][1, 1].tolist() == none
    assert [f.delay for f in gif.frames] == [5, 7, 1, 0]
    assert histogram(shown[0])[0b110000] == 16 and sum(histogram(shown[2])) == 16 - 2 - 1


def test_long_payloads_take_several_frames():
    data = bytes(np.random.default_rng(0).integers(0, 256, 64 * 50, dtype=np.uint8))
    gif = decode_gif(encode_gif(data, frame_rows=20))
    assert [f.height for f in gif.frames] == [20, 20, 10] and read_payload(gif)[0] == data


def test_payload_digests(spark):
    texts = [None, "", "a", "é" * 32, "x" * 64, "word " * 9000, "\x00\n日本"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, None), (None, "a")]
    got = payload_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r, (i, t) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)), sorted(rows, key=lambda x: (x[0] is None, x[0]))):
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % BLOCK if raw else BLOCK)
        assert (r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        colours = [0] * 64
        for b in payload:
            colours[(b >> 6) << 4 | (b >> 3 & 3) << 2 | b & 3] += 1
        assert list(map(int, r.feature.split(","))) == colours and r.media_sha256 == hashlib.sha256(encode_gif(payload)).hexdigest()
    assert payload_digests(spark.createDataFrame([], "doc_id long, text string, feature int")).count() == 0


def test_frames_as_rows(spark):
    files = [(1, made([(0, 0, 4, 4, 1, None, 5, False, [1] * 16), (1, 1, 2, 2, 2, 3, 7, False, [2, 3, 3, 2])])), (2, b"nothing"), (3, None)]
    got = sorted(gif_frames(spark.createDataFrame(files, "id long, media binary"), "id", "media").collect(), key=lambda r: (r.id, r.frame or 0))
    assert [(r.id, r.frame, r.start_ms, r.delay_ms, r.width) for r in got] == [(1, 0, 0, 50, 4), (1, 1, 50, 70, 4), (2, None, None, None, None), (3, None, None, None, None)]
    assert got[2].error and len(got[1].rgba) == 64 and sum(got[1].histogram) == 16


#: Files written by another program (fixed values): the well-known 10 x 10 sample image, and the smallest transparent pixel.
SAMPLE = bytes.fromhex("474946383961" "0a000a00" "910000" "ffffff" "ff0000" "0000ff" "000000" "21f90400000000002c000000000a000a0000" "0216" "8c2d99872a1cdc33a00275ec95faa8de608c04914c01" "003b")
PIXEL = bytes.fromhex("47494638396101000100800000000000ffffff21f90401000000002c00000000010001000002024401003b")


def test_files_of_other_encoders():
    gif = decode_gif(SAMPLE)
    rows = ["1111122222"] * 3 + ["1110000222"] * 2 + ["2220000111"] * 2 + ["2222211111"] * 3
    assert ["".join(map(str, r)) for r in gif.frames[0].indexes.tolist()] == rows
    (shown,) = canvases(gif)
    assert shown[0, 0].tolist() == [255, 0, 0, 255] and shown[4, 4].tolist() == [255, 255, 255, 255] and histogram(shown)[0b000011] == 42
    (shown,) = canvases(decode_gif(PIXEL))
    assert shown.tolist() == [[[0, 0, 0, 0]]]


def test_mutated_files_give_rows_or_errors(spark):
    r = random.Random(7)
    good = [SAMPLE, PIXEL, encode_gif(bytes(range(256)) * 3), made([(0, 0, 4, 4, 1, None, 5, False, [1] * 16), (1, 1, 2, 2, 2, 3, 7, True, [2, 3, 3, 2])])]
    files = []
    for i in range(2000):
        data = bytearray(r.choice(good))
        for _ in range(r.randrange(1, 6)):
            data[r.randrange(len(data))] = r.choice([0, 1, 63, 255, r.randrange(256)])
        files.append((i, bytes(data[: r.randrange(1, len(data) + 1)] if r.random() < 0.2 else data)))
    huge = bytearray(PIXEL)
    huge[6:10] = b"\xff" * 4
    wide = bytearray(PIXEL)
    wide[32:36] = b"\xff" * 4
    files += [(5000, bytes(huge)), (5001, bytes(wide)), (5002, PIXEL.replace(b"\x02\x02\x44", b"\x3f\x02\x44"))]
    got = gif_frames(spark.createDataFrame(files, "id long, media binary").repartition(4), "id", "media").select("id", "frame", "error").collect()
    assert {x.id for x in got} == {i for i, _ in files} and all((x.error is None) == (x.frame is not None) or x.error is None for x in got)
    assert all(next(x for x in got if x.id == i).error for i in (5000, 5001, 5002))


def test_payloads_beyond_the_bound_for_strangers(spark, monkeypatch):
    """The encoder's own files have no bound; here it is lowered, so that a short text passes it."""
    monkeypatch.setattr("lakeops.llm.gif.MOST_PIXELS", 1 << 12)
    data = bytes(i % 251 for i in range(1 << 14))
    media = encode_gif(data)
    with pytest.raises(ValueError, match="pixels"):
        decode_gif(media, 1 << 12)
    assert read_payload(decode_gif(media, None))[0] == data


def test_a_payload_of_more_than_64_mebibytes():
    import pyarrow as pa

    from lakeops.llm.gif import _digests

    text = "abcdefgh" * ((1 << 23) + 3)
    (batch,) = _digests(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["doc_id", "text"])]))
    row = batch.to_pylist()[0]
    padded = text.encode() + bytes(-len(text) % BLOCK)
    assert (row["n_bytes"], row["payload_bytes"], row["payload_sha256"]) == (len(text), len(padded), hashlib.sha256(padded).hexdigest())


def test_code_streams_that_end_early_are_errors(spark):
    whole = made([(0, 0, 4, 4, 0, None, 1, False, [1] * 16)])
    cut = made([(0, 0, 4, 4, 0, None, 1, False, [1, 2])])
    rows = {r.key: r for r in gif_frames(spark.createDataFrame([("whole", bytearray(whole)), ("cut", bytearray(cut))], "key string, data binary"), "key", "data").collect()}
    assert rows["whole"].error is None and "code stream" in rows["cut"].error and rows["cut"].rgba is None


def test_canvases_have_a_budget_and_leave_one_after_another(spark, monkeypatch):
    small = [(0, 0, 1, 1, 0, None, 1, False, [1])]
    many = made(small * 400, (2000, 2000))
    fits = made(small * 3, (2000, 2000))
    rows = gif_frames(spark.createDataFrame([("many", bytearray(many)), ("fits", bytearray(fits))], "key string, data binary"), "key", "data").drop("rgba").collect()
    assert [r.error for r in rows if r.key == "many"] == ["400 canvases of 2000 x 2000 pixels"]
    assert sorted(r.frame for r in rows if r.key == "fits") == [0, 1, 2]
