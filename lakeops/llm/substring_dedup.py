"""Exact removal of repeated 50-word windows by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document; its minimiser is the smallest hash among its
``MMER``-word runs. Consecutive windows with the same minimiser position form a super-k-mer. Equal windows
have equal minimisers, so only super-k-mers of one minimiser need to meet:

1. the minimisers are counted, and super-k-mers whose minimiser occurs once go;
2. the others are listed as (minimiser, digest of the words, doc_id, place); equal ones are pre-aggregated to their first document: every later
   copy goes whole, without its words being moved at all;
3. where a minimiser has several different super-k-mers, their words travel, once for each different one, as one packed string to
   the minimiser's bucket. A bucket is cut into parts of about ``WORK`` super-k-mers by the digests, so none grows with a group of near copies. In a
   part the windows are sorted as whole strings: of a run of equal ones all but those of the first document are marked;
4. the first documents' windows of buckets with several parts meet once more as (digest of the window, doc_id) in an ordinary aggregation;
5. the marked windows go back to their documents as word ranges.

Digests have 128 bits (BLAKE2), so equal digests mean equal words; the plain hashes only choose minimisers and part numbers.

Rows: every input row gives one row. Null, empty and short texts (under ``WINDOW`` words) lose nothing. Rows with the same
doc_id count as the same document; each of them is cut by its own words. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.storage import stored
from lakeops.llm.text import Words, hash_runs, slices, words

WINDOW = 50
MMER = 8
#: Different super-k-mers of one minimiser that are compared in one part.
WORK = 200

_PLACE = "minimiser long, key binary, doc_id long, copy long, start int, n int"
_PACKED = "bucket long, part int, parts int, doc_id long, copy long, origin int, start int, packed binary"
_MARKED = "doc_id long, copy long, origin int, start int, n int, open binary"


def _digest(packed: bytes) -> bytes:
    return hashlib.blake2b(packed, digest_size=16).digest()


def _super_kmers(found: Words, window: int, mmer: int) -> tuple[np.ndarray, ...]:
    """First word, number of windows, document and minimiser hash of each super-k-mer."""
    at = found.windows(window)
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none, none, none
    hashes = found.hashes()
    n = len(hashes)
    best = hash_runs(hashes, mmer)
    bits = np.uint64(max(1, int(n).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    exact = best
    best = (best & ~low) | np.arange(len(best), dtype=np.uint64)
    width, span = 1, window - mmer + 1
    while width * 2 <= span:
        best = np.minimum(best[:-width], best[width:]) if len(best) > width else best
        width *= 2
    best = np.minimum(best[at], best[at + span - width])
    place = (best & low).astype(np.int64)
    doc = np.searchsorted(found.first, at, "right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(at)))
    first = at[heads]
    return first, counts, doc[heads], exact[place[heads]].view(np.int64)


def _minimisers(window: int, mmer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([pa.array(_super_kmers(words(part.column(0)), window, mmer)[3])], ["minimiser"])

    return run


def _places(window: int, mmer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = words(part.column(1))
                first, counts, doc, minimiser = _super_kmers(found, window, mmer)
                if len(first):
                    text, starts, ends = found.joined()
                    keys = [_digest(text[a:b]) for a, b in zip(starts[first].tolist(), ends[first + counts + window - 2].tolist(), strict=True)]
                    ids = np.asarray(part.column(0))[doc]
                    copies = np.asarray(part.column(2))[doc]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(minimiser), pa.array(keys, pa.binary()), pa.array(ids), pa.array(copies), pa.array((first - found.first[doc]).astype(np.int32)), pa.array(counts.astype(np.int32))],
                        ["minimiser", "key", "doc_id", "copy", "start", "n"],
                    )

    return run


def _pack(window: int):
    """(doc_id, text, copy, ..., places) to packed super-k-mers with their buckets and parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.filter(batch.column(batch.num_columns - 1).is_valid())):
                found = words(part.column(1))
                text, starts, ends = found.joined()
                rows = []
                for i, (doc, copy, places) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(part.num_columns - 1).to_pylist(), strict=True)):
                    base = int(found.first[i])
                    for p in places:
                        a = base + p["start"]
                        rows.append((p["minimiser"], p["part"], p["parts"], doc, copy, p["start"], p["start"], text[starts[a] : ends[a + p["n"] + window - 2]]))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
                        ["bucket", "part", "parts", "doc_id", "copy", "origin", "start", "packed"],
                    )

    return run


def _judged(rows: list[tuple], window: int) -> list[tuple]:
    """One part of a bucket: the windows that an earlier document in it has, and, if the bucket has several parts, digests of the first documents' windows."""
    pieces = []
    for number, (_, doc, *_, packed) in enumerate(rows):
        spaces = np.flatnonzero(np.frombuffer(packed, np.uint8) == 0x20)
        heads = np.concatenate(([0], spaces + 1)).tolist()
        tails = np.concatenate((spaces, [len(packed)])).tolist()
        pieces += [(packed[heads[j] : tails[j + window - 1]], doc, number, j) for j in range(len(heads) - window + 1)]
    pieces.sort()
    marks, out, before, first, digest = [], [], None, 0, None
    for piece, doc, number, j in pieces:
        if piece != before:
            before, first, digest = piece, doc, None
        if doc > first:
            marks.append((number, j))
        elif rows[number][0] > 1:
            digest = digest or _digest(piece)
            _, _, copy, origin, start, _ = rows[number]
            out.append((doc, copy, origin, start + j, 1, digest))
    marks.sort()
    for i, (number, j) in enumerate(marks):
        _, doc, copy, origin, start, _ = rows[number]
        if i and marks[i - 1] == (number, j - 1):
            since[4] += 1
        else:
            out.append(since := [doc, copy, origin, start + j, 1, None])
    return out


def _marked(window: int):
    """Rows sorted by bucket and part to marked windows, as runs of window starts, and open ones with their digests."""
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["doc_id", "copy", "origin", "start", "n", "open"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for batch in batches:
            out = []
            for bucket, part, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (bucket, part) != group:
                    out += _judged(rows, window)
                    group, rows = (bucket, part), []
                rows.append(tuple(row))
            if out:
                yield made(out)
        if out := _judged(rows, window):
            yield made(out)

    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = words(part.column(1))
                drop = np.zeros(len(found.starts) + 1, np.int64)
                for i, spans in enumerate(part.column(part.num_columns - 1)):
                    if spans.is_valid and len(spans):
                        got = np.array([(s["start"], s["n"]) for s in spans.as_py()], np.int64) + [found.first[i], 0]
                        np.add.at(drop, got[:, 0], 1)
                        np.add.at(drop, got[:, 0] + got[:, 1] + window - 1, -1)
                gone = np.cumsum(drop)[:-1] > 0
                text, starts, ends = found.joined()
                removed = np.zeros(len(gone) + 1, np.int64)
                np.cumsum(gone, out=removed[1:])
                removed = removed[found.first[1:]] - removed[found.first[:-1]]
                kept = []
                for i, k in enumerate(removed.tolist()):
                    a, b = int(found.first[i]), int(found.first[i + 1])
                    if not k:
                        kept.append(text[starts[a] : ends[b - 1]] if b > a else b"")
                    else:
                        left = ~gone[a:b]
                        kept.append(b" ".join([text[s:e] for s, e in zip(starts[a:b][left], ends[a:b][left], strict=True)]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(found.counts.astype(np.int64)), pa.array(removed), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array([k.decode() if n else None for k, n in zip(kept, removed.tolist(), strict=True)], pa.string())],
                    [*part.schema.names[:-1], "n_words", "n_removed", "kept_sha256", "kept_text"],
                )

    return run


def remove_repeated_windows(docs: DataFrame, window: int = WINDOW, mmer: int = MMER, work: int = WORK, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, copy (a hash of the text, to tell rows of one doc_id apart), n_words, n_removed,
    kept_sha256 (of the kept words joined by one space), kept_text (those words; null where nothing was removed), text and the columns in ``carry``."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("copy"), *(c for c in carry if c not in ("doc_id", "text")))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema)
    known = docs.where("doc_id is not null")
    # most minimisers occur once: they are dropped on (minimiser, count) alone; reading the texts twice is cheaper than keeping all places
    frequent = known.select("text").mapInArrow(_minimisers(window, mmer), "minimiser long").groupBy("minimiser").agg(F.count("*").alias("uses")).where("uses > 1").select("minimiser")
    frequent = stored(frequent, "frequent-minimisers")  # so that both sides of the join are plain exchanges, which AQE splits where a minimiser is very common
    places = stored(known.select("doc_id", "text", "copy").mapInArrow(_places(window, mmer), _PLACE).join(frequent, "minimiser"), "super-kmers")
    # the different super-k-mers: their first and last document, and a place to read the words from
    distinct = stored(places.groupBy("minimiser", "key").agg(F.min(F.struct("doc_id", "copy", "start", "n")).alias("rep"), F.max("doc_id").alias("last"), F.count("*").alias("times")), "distinct-super-kmers")
    several = distinct.groupBy("minimiser").agg(F.count("*").alias("keys"), F.min("rep.doc_id").alias("low"), F.max("last").alias("high")).where("keys > 1 and low < high")
    several = stored(several.select("minimiser", F.ceil(F.col("keys") / work).cast("int").alias("parts")), "contested-minimisers")
    part = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part")
    contested = distinct.join(several, "minimiser").select("rep.doc_id", "rep.copy", F.struct("minimiser", part, "parts", "rep.start", "rep.n").alias("place"))
    wanted = contested.groupBy("doc_id", "copy").agg(F.collect_list("place").alias("places"))
    # a left join although only documents with places matter: both uses of docs then share one shuffle of the texts
    packed = (
        docs.join(wanted, ["doc_id", "copy"], "left").select(*docs.columns, "places").mapInArrow(_pack(window), _PACKED)
        .repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    )
    judged = stored(packed.mapInArrow(_marked(window), _MARKED), "judged-windows")
    met = judged.where("open is not null")
    firsts = stored(met.groupBy("open").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last"), "shared-windows")
    marked = judged.where("open is null").drop("open").unionByName(met.join(firsts, "open").where("doc_id > first").drop("open", "first"))
    # other places of a super-k-mer: later documents lose it whole; in the first document they share the marks of its place
    repeated = distinct.where("times > 1").select("minimiser", "key", "rep")
    others = places.join(repeated, ["minimiser", "key"]).where("doc_id > rep.doc_id or copy <> rep.copy or start <> rep.start")
    whole = others.where("doc_id > rep.doc_id").select("doc_id", "copy", "start", "n")
    again = others.where("doc_id = rep.doc_id").select("doc_id", "copy", "start", F.col("rep.copy").alias("m_copy"), F.col("rep.start").alias("origin"))
    echoed = (
        marked.withColumnsRenamed({"copy": "m_copy", "start": "m_start", "n": "m_n"}).join(again, ["doc_id", "m_copy", "origin"])
        .select("doc_id", "copy", (F.col("start") + F.col("m_start") - F.col("origin")).alias("start"), F.col("m_n").alias("n"))
    )
    spans = whole.unionByName(marked.drop("origin")).unionByName(echoed).groupBy("doc_id", "copy").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    cut = docs.join(spans, ["doc_id", "copy"], "left").select(*docs.columns, "spans")
    return cut.mapInArrow(_cut(window), f"{schema}, n_words long, n_removed long, kept_sha256 string, kept_text string")
