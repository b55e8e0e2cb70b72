"""GIF media columns: LZW code streams, palettes, transparency, disposal and timed frames.

``gif_frames`` turns a table of GIF files into one row per shown frame, with its times, the canvas after the frame (palette,
transparency and the disposal of earlier frames applied) and colour histograms. ``encode_gif`` stores bytes losslessly as palette
indexes of frames ``WIDTH`` pixels wide, each colour of the palette different; ``decode_gif`` reads any GIF87a or GIF89a stream back, and ``read_payload``
takes the bytes off the canvases as they are shown.

The widths of the LZW codes after a clear code depend on their number alone, so a whole run of codes is cut out of the bits at once.

Rows: one per input row in ``payload_digests``; a null text is an empty payload, padded to one block of zeros, and a payload may have any length. In ``gif_frames`` null
or broken files, files that ask for more than ``MOST_PIXELS`` pixels a canvas or in all frames together, and those that would show more than ``MOST_SHOWN`` pixels on all
canvases together give one row with null frame columns and the error; frames leave the task as they are drawn, about ``_SHOWN_BYTES`` at a time.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.text import slices

BLOCK = 64
WIDTH = 64
#: Rows of a stored frame; a longer payload takes several frames.
FRAME_ROWS = 4096
DELAY = 10  # hundredths of a second
#: Colour of each byte in the stored form: three bits of red, three of green, two of blue.
COLOURS = np.array([(i >> 5 << 5, (i >> 2 & 7) << 5, (i & 3) << 6) for i in range(256)], np.uint8)
#: Pixels of a canvas, and of all frames of a file, that are decoded.
MOST_PIXELS = 1 << 26
#: Pixels of all canvases of a file together.
MOST_SHOWN = 1 << 28
_SHOWN_BYTES = 16 << 20
_LAST = 4095


@cache
def _widths(clear: int) -> np.ndarray:
    """Bits of the codes after a clear code, until the table is full: when code k is read, the table has max(0, k - 1) new entries, and one more is due."""
    entries = clear + 2 + np.maximum(0, np.arange(_LAST - clear) - 1)
    return np.minimum(12, np.maximum(clear.bit_length(), np.ceil(np.log2(entries + 1)).astype(np.int64)))


@cache
def _heads(clear: int) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(_widths(clear))))


def lzw_encode(data: bytes, bits: int = 8) -> bytes:
    """The code stream of ``data``, least significant bit first, with a clear code whenever the table is full."""
    clear, end = 1 << bits, (1 << bits) + 1
    runs: list[list[int]] = []
    codes: list[int] = []
    table: dict[int, int] = {}
    find, put, free = table.get, codes.append, clear + 2
    rest = iter(data)
    code = next(rest, -1)
    for byte in rest:
        key = code << 8 | byte
        got = find(key)
        if got is not None:
            code = got
            continue
        put(code)
        code = byte
        table[key] = free
        free += 1
        if free == _LAST:
            put(code)
            put(clear)
            runs.append(codes)
            codes, table, free = [], {}, clear + 2
            find, put = table.get, codes.append
            code = next(rest, -1)
    codes += [code, end] if code >= 0 else [end]
    runs.append(codes)
    known = _widths(clear)
    widths = np.concatenate([[bits + 1], *(known[: len(r)] for r in runs)])
    values = np.concatenate([[clear], *(np.array(r, np.int64) for r in runs)])
    ends = np.cumsum(widths)
    at = ends - widths
    values = values << (at & 7)
    at >>= 3
    # the bits of different codes are apart, so sums of bytes are their union
    size = int(ends[-1] + 7 >> 3) + 3
    out = sum(np.bincount(at + k, weights=values >> 8 * k & 255, minlength=size) for k in range(3))
    return out[: size - 3].astype(np.uint8).tobytes()


def lzw_decode(stream: bytes, bits: int, expected: int) -> bytes:
    """At most ``expected`` values; a stream that ends early gives what it has, a code that does not exist yet raises ValueError."""
    if not 1 <= bits <= 8:
        raise ValueError(f"an LZW code size of {bits}")
    clear = 1 << bits
    data = np.zeros(len(stream) + 3, np.int32)
    data[:-3] = np.frombuffer(stream, np.uint8)
    length = 8 * len(stream)
    known, heads = _widths(clear), _heads(clear)

    def cut(places: np.ndarray, widths) -> np.ndarray:
        byte = places >> 3
        return (data[byte] | data[byte + 1] << 8 | data[byte + 2] << 16) >> (places & 7) & (1 << widths) - 1

    out: list[bytes] = []
    at = made = 0
    while at + bits < length and made < expected:
        n = min(int(np.searchsorted(heads, length - at, "right")) - 1, len(known))
        codes = cut(at + heads[:n], known[:n])
        stop = np.flatnonzero((codes == clear) | (codes == clear + 1))
        m = int(stop[0]) if len(stop) else n
        before = len(out)
        table = _run(codes[:m].tolist(), clear, out)
        made += sum(map(len, out[before:]))
        if len(stop):
            last = codes[m]
            at += int(heads[m + 1])
        else:
            # a full table without a clear code: codes stay 12 bits wide and no entry is added
            at += int(heads[m])
            left = (length - at) // 12
            codes = cut(at + 12 * np.arange(left), 12)
            stop = np.flatnonzero((codes == clear) | (codes == clear + 1))
            m = int(stop[0]) if len(stop) else left
            if (codes[:m] >= len(table)).any():
                raise ValueError("an LZW code before its entry")
            for code in codes[:m].tolist():
                out.append(table[code])
                made += len(table[code])
                if made >= expected:
                    break
            if not len(stop):
                break
            last = codes[m]
            at += 12 * (m + 1)
        if last == clear + 1:
            break
    return b"".join(out)[:expected]


def _run(codes: list[int], clear: int, out: list[bytes]) -> list[bytes]:
    """Appends the strings of a run of codes; gives the table that the run has built."""
    table = [bytes((i,)) for i in range(clear)] + [b"", b""]
    put, enter, before = out.append, table.append, b""
    for code in codes:
        try:
            now = table[code]
        except IndexError:
            if code != len(table) or not before:
                raise ValueError("an LZW code before its entry") from None
            now = before + before[:1]
        if before:
            enter(before + now[:1])
        before = now
        put(now)
    return table


@dataclass
class Frame:
    left: int
    top: int
    width: int
    height: int
    delay: int
    disposal: int
    transparent: int | None
    indexes: np.ndarray
    palette: np.ndarray


@dataclass
class Gif:
    width: int
    height: int
    background: int
    palette: np.ndarray | None
    frames: list[Frame]


def _blocks(parts: bytes, at: int) -> tuple[bytes, int]:
    got = []
    while size := parts[at]:
        got.append(parts[at + 1 : at + 1 + size])
        at += size + 1
    return b"".join(got), at + 1


def decode_gif(data: bytes, most_pixels: int | None = MOST_PIXELS) -> Gif:
    """The structure of a file with the colour indexes of all frames, interlaced ones put in order; ValueError if it is broken, or larger than a stranger's file may be
    (``most_pixels``; None: no bound, for files of our own)."""
    try:
        if data[:6] not in (b"GIF87a", b"GIF89a"):
            raise ValueError("no GIF signature")
        width, height, packed, background, _ = struct.unpack_from("<HHBBB", data, 6)
        if most_pixels is not None and width * height > most_pixels:
            raise ValueError(f"a canvas of {width} x {height} pixels")
        at, palette = 13, None
        if packed & 0x80:
            n = 2 << (packed & 7)
            palette = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
            at += 3 * n
        gif = Gif(width, height, background, palette, [])
        delay, disposal, transparent, pixels = 0, 0, None, 0
        while True:
            kind = data[at]
            if kind == 0x3B:
                return gif
            if kind == 0x21:
                label = data[at + 1]
                body, at = _blocks(data, at + 2)
                if label == 0xF9:
                    flags, delay, index = struct.unpack_from("<BHB", body)
                    disposal, transparent = flags >> 2 & 7, index if flags & 1 else None
                continue
            if kind != 0x2C:
                raise ValueError(f"an unknown block {kind:#x}")
            left, top, w, h, packed = struct.unpack_from("<HHHHB", data, at + 1)
            at, own = at + 10, palette
            if packed & 0x80:
                n = 2 << (packed & 7)
                own = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
                at += 3 * n
            if own is None:
                raise ValueError("a frame without a palette")
            pixels += w * h
            if most_pixels is not None and pixels > most_pixels:
                raise ValueError(f"frames of more than {most_pixels} pixels")
            bits = data[at]
            stream, at = _blocks(data, at + 1)
            values = lzw_decode(stream, bits, w * h)
            if len(values) < w * h:
                raise ValueError(f"a code stream of {len(values)} pixels for a frame of {w} x {h}")
            indexes = np.frombuffer(values, np.uint8).reshape(h, w)
            if packed & 0x40:
                rows = np.concatenate([np.arange(s, h, d) for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])
                straight = np.empty_like(indexes)
                straight[rows] = indexes
                indexes = straight
            gif.frames.append(Frame(left, top, w, h, delay, disposal, transparent, indexes, own))
            delay, disposal, transparent = 0, 0, None
    except (IndexError, struct.error) as short:
        raise ValueError("the file ends early") from short


def canvases(gif: Gif) -> Iterator[np.ndarray]:
    """The RGBA canvas as shown during each frame. Disposal 2 clears the frame's area afterwards, 3 brings back what was there before."""
    canvas = np.zeros((gif.height, gif.width, 4), np.uint8)
    for f in gif.frames:
        before = canvas.copy() if f.disposal == 3 else None
        spot = (slice(f.top, min(f.top + f.height, gif.height)), slice(f.left, min(f.left + f.width, gif.width)))
        area = canvas[spot]
        indexes = f.indexes[: area.shape[0], : area.shape[1]]
        shown = indexes < len(f.palette)
        if f.transparent is not None:
            shown &= indexes != f.transparent
        colours = np.full((256, 4), 255, np.uint8)
        colours[: len(f.palette), :3] = f.palette
        if shown.all():
            area[:] = colours[indexes]
        else:
            area[shown] = colours[indexes[shown]]
        yield canvas.copy()
        if f.disposal == 2:
            canvas[spot] = 0
        elif f.disposal == 3:
            canvas = before


def histogram(pixels: np.ndarray) -> list[int]:
    """Counts of the 64 colours with two bits a channel, over the opaque pixels."""
    p = pixels.reshape(-1, 4)
    if not p[:, 3].all():
        p = p[p[:, 3] > 0]
    return np.bincount(p[:, 0] >> 6 << 4 | p[:, 1] >> 6 << 2 | p[:, 2] >> 6, minlength=64).tolist()


def encode_gif(data: bytes, width: int = WIDTH, frame_rows: int = FRAME_ROWS) -> bytes:
    """``data`` (a multiple of ``width`` bytes) as the indexes of frames of at most ``frame_rows`` rows. They are shown one after another, each on a cleared canvas."""
    rows = len(data) // width
    out = [b"GIF89a", struct.pack("<HHBBB", width, min(rows, frame_rows), 0xF7, 0, 0), COLOURS.tobytes()]
    for top in range(0, rows, frame_rows):
        part = data[top * width : (top + frame_rows) * width]
        out += [b"\x21\xf9\x04", struct.pack("<BHBB", 2 << 2, DELAY, 0, 0), b"\x2c", struct.pack("<HHHHB", 0, 0, width, len(part) // width, 0), b"\x08"]
        stream = lzw_encode(part)
        out += [bytes((len(stream[i : i + 255]),)) + stream[i : i + 255] for i in range(0, len(stream), 255)] + [b"\0"]
    return b"".join([*out, b"\x3b"])


def read_payload(gif: Gif) -> tuple[bytes, list[list[int]]]:
    """The stored bytes, from the opaque pixels of the canvases as they are shown, and each frame's colour histogram."""
    parts, counts = [], []
    for canvas in canvases(gif):
        shown = canvas.reshape(-1, 4)
        if not shown[:, 3].all():
            shown = shown[shown[:, 3] > 0]
        parts.append((shown[:, 0] | shown[:, 1] >> 3 | shown[:, 2] >> 6).tobytes())
        counts.append(histogram(shown))
    return b"".join(parts), counts


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frames", "duration_ms"]
    for batch in batches:
        for part in slices(batch, rows=4096):
            rows = []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                raw = (text or "").encode()
                media = encode_gif(raw + bytes(-len(raw) % BLOCK if raw else BLOCK))
                gif = decode_gif(media, None)
                payload, counts = read_payload(gif)
                colours = ",".join(map(str, np.sum(counts, axis=0).tolist()))
                rows.append((doc, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), colours, len(gif.frames), sum(f.delay for f in gif.frames) * 10))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def payload_digests(docs: DataFrame) -> DataFrame:
    """Every text stored as a GIF and read back: sizes, digests, and the histogram of 64 colours over its frames as ``feature``."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_digests, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frames long, duration_ms long")


def gif_frames(media: DataFrame, key: str, column: str) -> DataFrame:
    """One row per frame: the key, frame, start_ms, delay_ms, disposal, width, height, rgba (the canvas's pixels), histogram and error."""

    names = [key, "frame", "start_ms", "delay_ms", "disposal", "width", "height", "rgba", "histogram", "error"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.string()]

    def frames(data: bytes | None) -> Iterator[tuple]:
        """The rows of a file. All that can be wrong with it is found before the first one."""
        try:
            gif = decode_gif(data or b"")
            if len(gif.frames) * gif.width * gif.height > MOST_SHOWN:
                raise ValueError(f"{len(gif.frames)} canvases of {gif.width} x {gif.height} pixels")
            if not gif.frames:
                raise ValueError("no frames")
        except ValueError as broken:
            yield (None,) * 8 + (str(broken),)
            return
        start = 0
        for i, (f, canvas) in enumerate(zip(gif.frames, canvases(gif), strict=True)):
            yield i, start, f.delay * 10, f.disposal, gif.width, gif.height, canvas.tobytes(), histogram(canvas), None
            start += f.delay * 10

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, data in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                rows, held = [], 0

                def out(rows: list[tuple], k=k, kind=batch.schema.field(0).type) -> pa.RecordBatch:
                    return pa.RecordBatch.from_arrays([pa.array([k.as_py()] * len(rows), kind), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names)

                for row in frames(data):
                    rows.append(row)
                    held += len(row[6] or b"")
                    if held >= _SHOWN_BYTES:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    kind = media.schema[key].dataType.simpleString()
    return media.select(key, column).mapInArrow(run, f"`{key}` {kind}, frame int, start_ms long, delay_ms long, disposal int, width int, height int, rgba binary, histogram array<long>, error string")
