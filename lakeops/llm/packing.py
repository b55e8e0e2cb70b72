"""Best-fit-decreasing packing of tokenized documents into sequences of bounded length.

1. Each document becomes its tokens and an end token; longer ones are cut into full pieces and a rest. A task numbers its pieces of each
   length. Tokens stay in their task (unless ``ids`` asks for them), so rows are small.
2. Pieces of one length are alike, so the packing only needs how many there are: ``capacity`` numbers at most, whatever the table's size.
   ``best_fit_decreasing`` packs these counts, longest first: a segment tree over remaining capacities finds the tightest open sequences
   in logarithmic time, and as many pieces go in as these sequences take. The outcome is that of placing the pieces one by one. It is a list of moves
   (pieces r to s of length l go to sequences b, b + 1, ... at offset o). Sequences stay in runs of neighbours: a length cuts at most one run and opens at
   most two, so there are at most 3 * capacity runs, and a sequence holds at most sqrt(2 * capacity) different lengths; the moves are bounded by the product.
3. The pieces of a length are numbered through all tasks by running sums over the tasks' counts, and every piece looks its place up in the moves.

Rows: one per piece; at least one per input row, whatever its doc_id is. A null or empty text has the end token alone. Repeated rows are packed as
often as they come. An empty table has no rows. Columns besides doc_id and text are ignored.

Tokens are those of the ``tokenizers`` library, special tokens' strings being ordinary text. Its pre-tokenizer here never looks past white space, so a text is
cut there and each distinct run of a slice is encoded once: runs of Latin letters, digits and ASCII signs by merging many side by side
with numpy, all others by the library itself. Tokenizers of another build encode whole texts by the library.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.storage import stored
from lakeops.llm.text import SPACE, Words, per_doc, slices, words

CAPACITY = 4096
END = 1
#: Encoded runs that a worker remembers; more are encoded again.
KNOWN = 300_000
#: Runs of this many bytes or more go to the library.
LONG = 64
_SLICE = 10 << 20
_TOGETHER = 50_000
_LETTER, _DIGIT, _SIGN, _FOREIGN = 0, 1, 2, 3
#: Classes of bytes in plain runs: ASCII, and the letters of Latin-1, whose first byte is C3.
_KIND = np.full(256, _FOREIGN, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x61:0x7B] = _LETTER
_KIND[0x41:0x5B] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _pretokens(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes in lower case, and the starts and ends of the pre-tokens of plain runs and of all other runs whole, with a mark for the latter."""
    raw = found.buf
    buf, kind = _LOWER[raw], _KIND[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3) if len(raw) else np.zeros(0, np.int64)
    then = raw[lead + 1]
    letter = lead[(then >= 0x80) & (then != 0x97) & (then != 0xB7)]
    kind[letter] = kind[letter + 1] = _LETTER
    upper = letter[raw[letter + 1] < 0x9F] + 1
    buf[upper] += 0x20
    sums = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(kind == _FOREIGN, out=sums[1:])
    foreign = sums[found.ends] > sums[found.starts]
    begin = np.zeros(len(buf) + 1, bool)
    begin[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    begin[found.starts] = True
    # contractions: an apostrophe that begins a run of signs takes the letters after it
    mark = np.flatnonzero((buf == 0x27) & begin[:-1])
    next_, after = buf[np.minimum(mark + 1, len(buf) - 1)], buf[np.minimum(mark + 2, len(buf) - 1)]
    left = found.ends[np.searchsorted(found.ends, mark, "right")]
    one = np.isin(next_, np.frombuffer(b"stmd", np.uint8)) & (mark + 2 <= left)
    two = (((next_ == 0x72) | (next_ == 0x76)) & (after == 0x65) | (next_ == 0x6C) & (after == 0x6C)) & (mark + 3 <= left)
    for at, n in ((mark[one], 2), (mark[two], 3)):
        begin[at + 1] = False
        begin[at + n] = True
    if foreign.any():
        n = (found.ends - found.starts)[foreign]
        begin[np.arange(int(n.sum())) + np.repeat(found.starts[foreign] - (np.cumsum(n) - n), n)] = False
        begin[found.starts[foreign]] = True
    word = np.append(~SPACE[raw], False)
    starts = np.flatnonzero(begin & word)
    stop = begin | ~word
    stop[found.ends] = True
    ends = np.flatnonzero(stop[1:] & word[:-1]) + 1
    other = np.zeros(len(starts), bool)
    other[np.searchsorted(starts, found.starts[foreign])] = True
    return buf, starts, ends, other


def _gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[start:start + size]`` of all spans one after another, and the sizes."""
    shift = (starts - np.cumsum(sizes) + sizes).astype(np.int32)
    return values[np.arange(int(sizes.sum()), dtype=np.int32) + np.repeat(shift, sizes)], sizes


def _numbers(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each span of fewer than ``LONG`` bytes, the same one if and only if their bytes are equal, and the first span of each number.
    Bytes are read eight at a time; a hash of the eights finds equal spans, the eights decide."""
    eights = np.ndarray(len(buf) + 1, "<u8", np.append(buf, np.zeros(8, np.uint8)).data, strides=(1,))
    sizes = ends - starts
    key, read, some = np.zeros(len(starts), np.uint64), [], np.arange(len(starts), dtype=np.int32)
    for j in range(0, LONG, 8):
        if j:
            some = some[sizes[some] > j]
        if not len(some):
            break
        here = eights[starts[some] + j] & _FIRST[np.minimum(sizes[some] - j, 8)]
        read.append((some, here))
        mixed = (key[some] ^ here) * np.uint64(0x9E3779B97F4A7C15)
        key[some] = mixed ^ (mixed >> np.uint64(29))
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    twin = first[number]
    whole = np.zeros(len(starts), np.uint64)
    for some, here in read:
        whole[some] = here
        if not (whole[twin[some]] == here).all() or not (sizes[twin[some]] == sizes[some]).all():
            known: dict[bytes, int] = {}
            data = buf.tobytes()
            number = np.array([known.setdefault(data[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
            return number, np.unique(number, return_index=True)[1]
    return number, first


#: Masks of the first n bytes of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


#: The build for which cutting at white space is exact.
_BUILD = (
    [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "</w>",
)


class _Pairs:
    """Pairs of tokens and the token each makes, in an open table that is read for many pairs at once."""

    NONE = 1 << 40

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(10, (16 * max(1, len(pairs)) - 1).bit_length())
        self.keys, self.made = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, self.NONE)
        for (a, b), made in pairs.items():
            key = a << 32 | b
            at = int(self._spot(np.array([key]))[0])
            while self.keys[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.made[at] = key, made

    def _spot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def made_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 32 | b
        at = self._spot(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.made[at], self.NONE)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            there = self.keys[at[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.made[at[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out


class Encoder:
    """Texts to ids as the ``tokenizers`` library gives them, many texts at once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            build = json.load(file)
        self.known: dict[bytes, np.ndarray] = {}
        model, cut = build["model"], (build["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        vocab, suffix = model.get("vocab"), model.get("end_of_word_suffix")
        signs = _byte_signs()
        self.by_runs = ((build["normalizer"] or {}).get("normalizers"), cut[0].get("pattern"), suffix) == _BUILD and model["type"] == "BPE" and len(cut) == 2
        if self.by_runs:
            merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
            made = [vocab[a + b] for a, b in merges]
            self.by_runs = all(s + suffix in vocab and s in vocab for s in signs) and all(x < y for x, y in zip(made, made[1:], strict=False))
        if self.by_runs:  # made tokens are numbered in the order of merging, so the smallest one merges first
            self.inside, self.last = np.array([vocab[s] for s in signs], np.int64), np.array([vocab[s + suffix] for s in signs], np.int64)
            self.pairs = _Pairs({(vocab[a], vocab[b]): m for (a, b), m in zip(merges, made, strict=True)})

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        if not self.by_runs:
            ids = [np.array(e.ids, np.uint32) for e in self.library.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.array([len(i) for i in ids], np.int64)
        found = words(texts)
        buf, starts, ends, other = _pretokens(found)
        other |= ends - starts >= LONG
        number, first = _numbers(buf, starts[~other], ends[~other])
        flat, sizes = [], []
        plain = np.flatnonzero(~other)[first]
        for begin in range(0, len(plain), _TOGETHER):
            some = plain[begin : begin + _TOGETHER]
            ids, n = self._merged(*_gathered(buf, starts[some], ends[some] - starts[some]))
            flat.append(ids.astype(np.uint32))
            sizes.append(n)
        theirs, nth = self._of_library([found.buf[a:b].tobytes() for a, b in zip(starts[other].tolist(), ends[other].tolist(), strict=True)])
        flat = np.concatenate([*flat, *theirs, np.zeros(0, np.uint32)])
        sizes = np.concatenate([*sizes, np.array([len(t) for t in theirs], np.int64)])
        every = np.empty(len(starts), np.int64)
        every[~other] = number
        every[other] = nth + len(plain)
        counts = sizes[every]
        return _gathered(flat, (np.cumsum(sizes) - sizes)[every], counts)[0], per_doc(counts, np.searchsorted(starts, found.offsets))

    def _of_library(self, texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """The ids of each different text, and which of them each text is."""
        number = defaultdict(lambda: len(number))
        nth = np.fromiter((number[t] for t in texts), np.int64, len(texts))
        known, new = self.known, [t for t in number if t not in self.known]
        if len(known) + len(new) > KNOWN:
            known.clear()
            new = list(number)
        known.update((t, np.array(e.ids, np.uint32)) for t, e in zip(new, self.library.encode_batch([t.decode() for t in new], add_special_tokens=False), strict=True))
        return [known[t] for t in number], nth

    def _merged(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all spans one after another, and how many each has: in each round every span merges the pair that makes its smallest token, the leftmost first."""
        out_at, out_sizes = np.cumsum(sizes) - sizes, sizes.copy()
        token = self.inside[data]
        token[out_at + sizes - 1] = self.last[data[out_at + sizes - 1]]
        out, filled = token.copy(), np.ones(len(token), bool)
        made = np.full(len(token), self.pairs.NONE)
        made[:-1] = self.pairs.made_of(token[:-1], token[1:])
        owner = np.arange(len(sizes))
        while len(owner):
            heads = np.cumsum(sizes) - sizes
            made[heads + sizes - 1] = self.pairs.NONE
            best = np.minimum.reduceat(made, heads)
            done = best == self.pairs.NONE
            if done.any():
                ended, n = owner[done], sizes[done]
                inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                places = np.repeat(out_at[ended], n) + inside
                gone = np.repeat(out_at[ended], out_sizes[ended]) + np.arange(int(out_sizes[ended].sum())) - np.repeat(np.cumsum(out_sizes[ended]) - out_sizes[ended], out_sizes[ended])
                filled[gone] = False
                left = np.repeat(~done, sizes)
                out[places], filled[places], out_sizes[ended] = token[~left], True, n
                token, made, owner, sizes, best = token[left], made[left], owner[~done], sizes[~done], best[~done]
                if not len(owner):
                    break
                heads = np.cumsum(sizes) - sizes
            hits = np.flatnonzero(made == np.repeat(best, sizes))
            at = hits[np.searchsorted(hits, heads)]
            token[at] = best
            kept = np.ones(len(token), bool)
            kept[at + 1] = False
            at -= np.arange(len(at))
            token, made, sizes = token[kept], made[kept], sizes - 1
            for i in (at, at[at > 0] - 1):
                i = i[i + 1 < len(token)]
                made[i] = self.pairs.made_of(token[i], token[i + 1])
        return out[filled], out_sizes


def _byte_signs() -> list[str]:
    """The sign that stands for each byte: itself if it is printable, else the next free one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in printable)
    return [s for _, s in sorted([(b, chr(b)) for b in printable] + [(b, chr(256 + i)) for i, b in enumerate(others)])]


class _Openings:
    """A segment tree over remaining capacities: which of them an open sequence has."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.some = [False] * (2 * self.width)

    def set(self, c: int, some: bool) -> None:
        c += self.width
        self.some[c] = some
        while c > 1:
            c >>= 1
            self.some[c] = self.some[2 * c] or self.some[2 * c + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest capacity with an open sequence that is ``least`` or more."""
        i = least + self.width
        if not self.some[i]:
            while i > 1 and (i & 1 or not self.some[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
        while i < self.width:
            i = 2 * i if self.some[2 * i] else 2 * i + 1
        return i - self.width


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Packs ``counts[l]`` pieces of each length l. Moves (length, first piece, first sequence, pieces a sequence, offset): from its first piece on, up to the next move's,
    the pieces of this length fill one sequence after another, each with so many of them from this offset on."""
    tree, runs, moves, used = _Openings(capacity), defaultdict(list), [], 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"pieces of {length} tokens don't fit into {capacity}")
        piece, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, n = capacity, -(-left // (capacity // length))
                begin, used = used, used + n
            else:
                begin, n = runs[room].pop()
            each = room // length
            moves.append((length, piece, begin, each, capacity - room))
            full = min(n, left // each)
            rest = min(left - full * each, each) if full < n else 0
            for first, many, now in ((begin, full, room - each * length), (begin + full, int(rest > 0), room - rest * length), (begin + full + (rest > 0), n - full - (rest > 0), room)):
                if many:
                    runs[now].append((first, many))
                    if now:
                        tree.set(now, True)
            if not runs[room]:
                tree.set(room, False)
            piece += full * each + rest
            left -= full * each + rest
    return moves


_encoders: dict[str, Encoder] = {}


def _pieces(path: str, capacity: int, end: int, ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encoder, task, seen = _encoders[path], TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in slices(batch, most=_SLICE, rows=1 << 16):
                flat, counts = encoder.encode(part.column(1))
                heads = np.cumsum(counts)
                flat = np.insert(flat, heads, end).astype("<u4")
                totals = counts + 1
                pieces = -(-totals // capacity)
                doc = np.repeat(np.arange(len(totals)), pieces)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth * capacity
                length = np.minimum(totals[doc] - start, capacity)
                at = np.repeat(np.cumsum(totals) - totals, pieces) + start
                data = memoryview(flat).cast("B")
                crc = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                _, begins, many = np.unique(length[order], return_index=True, return_counts=True)
                number = np.empty(len(length), np.int64)
                number[order] = np.arange(len(length)) - np.repeat(begins, many)
                number += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                columns = [part.column(0).take(pa.array(doc)), pa.array(nth, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), task), pa.int32()), pa.array(number)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"]
                if ids:  # pieces stand one after another, as their tokens do
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate((at, [len(flat)])), pa.int32()), pa.array(flat.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _places(moves: list[tuple[int, int, int, int, int]]):
    table = np.array(sorted(moves) or [(0, 0, 0, 1, 0)], np.int64).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[0] << 48 | table[1]
        for batch in batches:
            length, number = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("length", "number"))
            at = np.searchsorted(keys, length << 48 | number, "right") - 1
            inside = number - table[1][at]
            sequence, offset = table[2][at] + inside // table[3][at], table[4][at] + inside % table[3][at] * length
            kept = [i for i, f in enumerate(batch.schema) if f.name != "number"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(sequence), pa.array(offset)], [*(batch.schema.field(i).name for i in kept), "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, the ids themselves of every piece."""
    more = ", ids array<int>" if ids else ""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    pieces = stored(texts.mapInArrow(_pieces(path, capacity, end, ids), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, number long{more}"), "pieces")
    tasks = stored(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = tasks.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    numbered = pieces.join(begins.hint("merge"), ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else []), (F.col("number") + F.col("begin")).alias("number"))
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long{more}, sequence_id long, offset long"
    return numbered.mapInArrow(_places(best_fit_decreasing(counts, capacity)), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids and the doc_ids of its pieces, in order, from pieces with their ids; no sequence is longer than the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select("sequence_id", "n_tokens", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
