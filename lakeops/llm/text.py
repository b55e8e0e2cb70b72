"""Words of whole Arrow batches, found and hashed with numpy.

A word is ``[^\\x20\\x09-\\x0D]+``; a null text has none. All helpers work on slices of at most
``CHUNK_BYTES`` of text (one longer document makes a slice of its own), so a Python worker's memory
follows the slice and not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_factors = np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def factors(n: int) -> np.ndarray:
    """A factor of its own for each of the first ``n`` places; unlike powers of a base they have no relations that repetitive input could meet."""
    global _factors
    if len(_factors) < n:
        _factors = mix(np.arange(1, max(n, 1 << 12) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return _factors[:n]


def hash_spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for each of the given spans, which are not empty, in order and apart from each other."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    head = np.zeros(len(values), np.int64)
    head[starts] = starts
    inside = np.arange(len(values)) - np.maximum.accumulate(head)
    weighed = np.zeros(len(values) + 1, np.uint64)
    np.multiply(values, factors(int(inside.max()) + 1)[inside], out=weighed[:-1])
    sums = np.add.reduceat(weighed, np.column_stack((starts, ends)).reshape(-1))[::2]
    return mix(sums + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def hash_runs(values: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of ``values[i:i + size]`` for each i where the run fits."""
    n = max(0, len(values) - size + 1)
    total = np.full(n, np.uint64(size), np.uint64)
    for j, factor in enumerate(factors(size)):
        total += values[j : j + n] * factor
    return mix(total)


@dataclass
class Words:
    """The words of a slice: byte ranges in ``buf``; document ``i`` has words ``first[i]:first[i+1]``."""

    buf: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return hash_spans(_BYTE[self.buf], self.starts, self.ends)

    def numbers(self, hashes: np.ndarray | None = None) -> np.ndarray:
        """A number for each word; two words have the same one if and only if all their bytes are equal. Hashes find the equal ones, the bytes decide."""
        _, first, same = np.unique(self.hashes() if hashes is None else hashes, return_index=True, return_inverse=True)
        lengths = self.ends - self.starts
        twin = first[same]
        if (lengths == lengths[twin]).all():
            inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            if (self.buf[np.repeat(self.starts, lengths) + inside] == self.buf[np.repeat(self.starts[twin], lengths) + inside]).all():
                return same
        text, known = self.buf.tobytes(), {}
        return np.fromiter((known.setdefault(text[a:b], len(known)) for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)), np.int64, len(self.starts))

    def windows(self, size: int) -> np.ndarray:
        """Start indexes of the runs of ``size`` words that lie inside one document."""
        n = len(self.starts)
        inside = np.zeros(n, bool)
        limit = np.repeat(self.first[1:], self.counts)
        np.less_equal(np.arange(n) + size, limit, out=inside)
        return np.flatnonzero(inside)

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words with one space after each, and their new byte ranges."""
        word = ~SPACE[self.buf]
        keep = word.copy()
        lengths = self.ends - self.starts
        starts = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths + 1, out=starts[1:])
        out = np.full(int(starts[-1]), 0x20, np.uint8)
        place = np.ones(len(out), bool)
        place[starts[1:] - 1] = False
        out[place] = self.buf[keep]
        return out.tobytes(), starts[:-1], starts[:-1] + lengths


def words(texts: pa.Array) -> Words:
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    word = ~SPACE[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = word[:-1]
    edges = offsets[:-1][offsets[:-1] < len(buf)]
    before[edges] = False
    starts = np.flatnonzero(word & ~before)
    after = np.zeros(len(buf), bool)
    after[:-1] = word[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    return Words(buf, offsets, starts, ends, np.searchsorted(starts, offsets))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of at most ``rows`` rows with about ``most`` bytes of text each."""
    if batch.num_rows == 0:
        return
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = np.asarray(pc.binary_length(texts).fill_null(0))
    at = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        done = at[start - 1] if start else 0
        end = min(max(start + 1, int(np.searchsorted(at, done + most, "right"))), start + rows)
        yield batch.slice(start, end - start)
        start = end


def per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the ranges ``first[i]:first[i+1]``."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
