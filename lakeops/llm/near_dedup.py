"""Near-duplicate groups by BagMinHash signatures over multisets of five-word shingles.

A document is a multiset of shingles (``SHINGLE`` words; a text with fewer words is one shingle). Its signature has
``REGISTERS`` registers. Each shingle of weight w owns independent Poisson processes over the weight axis, cut into dyadic
blocks [0,1) [1,2) [2,4) [4,8) ...; a point has a time, a register and a place on the axis, all from a hash of shingle, block
and number of the point. The points at places below w count, so equal parts of two weights share their points, and the cost
grows with log w. A register keeps its earliest point: two documents agree on a register with the probability of their
weighted Jaccard similarity sum(min)/sum(max). Points are drawn in the order of time up to a limit per document, and
on until every register is filled.

Documents with the same words (128-bit digests) are collapsed to their smallest doc_id first. The rest meet in ``BANDS`` bands. In a bucket
every member is compared with one leader, the member that meets most others; the comparison counts the true overlap of the two
multisets, so a group of copies costs a row per member. Buckets that still hold several components are not compared pair by pair.
Their members go through an exact prefix filter: with all shingles in order of frequency, two documents can only be similar if
the first shingle they share stands so early in both that what follows is still enough. Only pairs of different components
with such a shingle are compared. No link is lost within a bucket, and many dissimilar variants of one text cost next to nothing, since
their own shingles come first. Two documents at similarity 0.8 share no bucket with probability 3e-6.

Rows: one per input row. Null texts and texts without a word are never grouped: they are their own class. Rows that share a
doc_id count as one document. A null doc_id has a null class. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.storage import stored
from lakeops.llm.text import Words, hash_runs, hash_spans, mix, per_doc, slices, words

SHINGLE = 5
SIMILARITY = 0.8
REGISTERS = 96
BANDS = 24
_ROWS = 4096
_LOW = np.uint64((1 << 52) - 1)
_word = re.compile(rb"[^\x20\x09-\x0D]+").findall


def _shingles(found: Words, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word, number of words and hash (52 bits) of every shingle; those of texts with fewer words come last."""
    at = found.windows(size)
    short = np.flatnonzero((found.counts > 0) & (found.counts < size))
    doc = np.concatenate((np.searchsorted(found.first, at, "right") - 1, short))
    starts = np.concatenate((at, found.first[short]))
    lengths = np.concatenate((np.full(len(at), size), found.counts[short]))
    shingle = np.concatenate((hash_runs(hashes, size)[at], hash_spans(hashes, found.first[short], found.first[short + 1])))
    return doc, starts, lengths, shingle & _LOW


def _bags(found: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, shingle (52 bits) and count of each different shingle, in order of document and shingle."""
    doc, _, _, shingle = _shingles(found, size, found.hashes())
    key, count = np.unique((doc.astype(np.uint64) << np.uint64(52)) | shingle, return_counts=True)
    return (key >> np.uint64(52)).astype(np.int64), key & _LOW, count


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_docs: int, registers: int = REGISTERS) -> np.ndarray:
    """Earliest times, n_docs x registers; infinite for documents without shingles."""
    out = np.full(n_docs * registers, np.inf)
    blocks = np.ceil(np.log2(weight)).astype(np.int64) + 1
    owner = np.repeat(np.arange(len(doc)), blocks)
    block = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low = np.where(block > 0, 2.0 ** (block - 1), 0.0)
    width = np.where(block > 0, low, 1.0)
    doc, weight = doc[owner], weight[owner]
    seed = mix(shingle[owner] + block.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    total = np.bincount(doc, weights=np.minimum(weight - low, width), minlength=n_docs)
    limit = np.where(total > 0, registers * (np.log(registers) + 3) / np.maximum(total, 1), 0.0)
    number = np.zeros(len(doc), np.uint64)

    def step(i: np.ndarray, then: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        number[i] += np.uint64(1)
        draw = mix(seed[i] + number[i] * np.uint64(0x9FB21C651E98DF25))
        return then - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53) / width[i], draw

    everything = np.arange(len(doc))
    time, draw = step(everything, np.zeros(len(doc)))
    open_ = everything
    while len(open_):
        act = open_[time[open_] <= limit[doc[open_]]]
        while len(act):
            spot = mix(draw[act] ^ np.uint64(0xD6E8FEB86659FD93))
            place = low[act] + (spot >> np.uint64(32)).astype(np.float64) / 2.0**32 * width[act]
            hit = act[place < weight[act]]
            register = ((spot[place < weight[act]] & np.uint64(0xFFFFFFFF)) * np.uint64(registers)) >> np.uint64(32)
            np.minimum.at(out, doc[hit] * registers + register.astype(np.int64), time[hit])
            time[act], draw[act] = step(act, time[act])
            act = act[time[act] <= limit[doc[act]]]
        unfilled = np.isinf(out.reshape(n_docs, registers)).any(1) & (total > 0)
        limit[unfilled] *= 2
        open_ = open_[unfilled[doc[open_]]]
    return out.reshape(n_docs, registers)


def _sketch(size: int, registers: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows=_ROWS):
                found = words(part.column(1))
                doc, shingle, count = _bags(found, size)
                n = part.num_rows
                times = signatures(doc, shingle, count, n, registers)
                value = mix(times.view(np.uint64) + np.arange(registers, dtype=np.uint64))
                rows = registers // bands
                flat = np.arange(n * bands) * rows
                band = hash_spans(value.reshape(-1), flat, flat + rows)
                text, starts, ends = found.joined()
                has = found.counts > 0
                bounds = zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True)
                idents = [hashlib.blake2b(text[starts[a] : ends[b - 1]] if b > a else b"", digest_size=16).digest() for a, b in bounds]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(band.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(idents, pa.binary()), lists], ["doc_id", "ident", "bands"]).filter(pa.array(has))

    return run


def _overlaps(size: int):
    """Weighted Jaccard similarity of two texts of each row. Hashes bring shingles together, their words decide."""

    def exact(text: bytes | None) -> Counter:
        w = _word(text or b"")
        return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column="text_a", rows=_ROWS // 2):
                n = part.num_rows
                found = words(pa.concat_arrays([part.column(2), part.column(3)]))
                hashes = found.hashes()
                doc, starts, lengths, shingle = _shingles(found, size, hashes)
                key, first, same = np.unique(((doc % n).astype(np.uint64) << np.uint64(52)) | shingle, return_index=True, return_inverse=True)
                a, b = (np.bincount(same[side], minlength=len(key)) for side in (doc < n, doc >= n))
                pair = (key >> np.uint64(52)).astype(np.int64)
                both, union = (np.bincount(pair, weights=f(a, b), minlength=n) for f in (np.minimum, np.maximum))
                similarity = both / np.maximum(union, 1)
                twin, number, differs = first[same], found.numbers(hashes), lengths != lengths[first[same]]
                for k in range(size):
                    spot = np.minimum(k, lengths - 1)
                    differs |= number[starts + spot] != number[starts[twin] + np.minimum(k, lengths[twin] - 1)]
                for i in np.unique(doc[differs] % n).tolist():
                    x, y = (exact(part.column(c)[i].as_py().encode()) for c in (2, 3))
                    similarity[i] = (x & y).total() / max(1, (x | y).total())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(similarity)], ["a", "b", "similarity"])

    return run


def _elements(size: int):
    """(node, component, text) to the elements of the multiset: a shingle that occurs w times gives w different elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows=_ROWS):
                doc, shingle, count = _bags(words(part.column(2)), size)
                doc, shingle = np.repeat(doc, count), np.repeat(shingle, count)
                turn = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                flat = mix(shingle + turn.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)).view(np.int64)
                heads = np.searchsorted(doc, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(pa.array(heads, pa.int32()), pa.array(flat))], ["node", "component", "elements"])

    return run


def prefix_pairs(docs: DataFrame, nodes: DataFrame, similarity: float, size: int = SHINGLE) -> DataFrame:
    """All pairs (a, b) of ``nodes`` (node, component) of different components that the positional prefix filter can't rule out."""
    texts = docs.withColumnRenamed("doc_id", "node").join(nodes, "node").select("node", "component", "text")
    bags = stored(texts.mapInArrow(_elements(size), "node long, component long, elements array<long>"), "elements")
    flat = bags.select("node", "component", F.size("elements").alias("size"), F.explode("elements").alias("element"))
    uses = flat.groupBy("element").agg(F.count("*").alias("uses"))
    ranked = flat.join(uses, "element").withColumn("place", F.row_number().over(Window.partitionBy("node", "component", "size").orderBy("uses", "element")) - 1)
    # element number `place` of a document leaves at most size - place common ones, itself included
    heads = ranked.where((F.col("uses") > 1) & (F.col("size") - F.col("place") >= F.ceil(similarity * F.col("size") - 1e-9))).select("element", "node", "component", "size", (F.col("size") - F.col("place")).alias("left"))
    heads = stored(heads, "prefixes")
    x, y = heads.alias("x"), heads.alias("y")
    enough = F.least("x.left", "y.left") >= F.ceil(similarity / (1 + similarity) * (F.col("x.size") + F.col("y.size")) - 1e-9)
    met = x.join(y, (F.col("x.element") == F.col("y.element")) & (F.col("x.component") < F.col("y.component")) & enough)
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def verified(docs: DataFrame, pairs: DataFrame, similarity: float, size: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) whose texts' multisets overlap enough."""
    left = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_overlaps(size), "a long, b long, similarity double").where(F.col("similarity") >= similarity - 1e-9)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that a node is connected with, by alternating large and small stars.
    Every round is written to the shared folder; neighbours are aggregated and joined, never gathered in one row."""
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        # done when every node has one neighbour below it and that one has none
        forked = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
        chained = edges.select(F.col("v").alias("u")).join(edges, "u", "left_semi")
        if forked.unionByName(chained).isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = stored(small.where("u <> v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _rooted(links: DataFrame, side: str, grouped: DataFrame) -> DataFrame:
    """Links with one end's component in the place of its node."""
    roots = grouped.select(F.col("node").alias(side), F.col("component").alias("_root"))
    return links.join(roots, side, "left").withColumn(side, F.coalesce("_root", side)).drop("_root")


def near_duplicate_classes(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (the smallest doc_id of its group) and kept (whether it is that document)."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = docs.where("doc_id is not null")
    sketched = stored(known.mapInArrow(_sketch(size, REGISTERS, BANDS), "doc_id long, ident binary, bands array<long>"), "signatures")
    firsts = stored(sketched.groupBy("ident").agg(F.min("doc_id").alias("node")), "copies")
    nodes = sketched.join(firsts, (sketched.doc_id == firsts.node) & (sketched.ident == firsts.ident)).select("node", "bands")
    rows = nodes.select("node", F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    # stored, like the leaders and mixed buckets below: both sides of the joins are then plain exchanges, which AQE splits at a large bucket
    shared = stored(rows.join(stored(sizes, "band-sizes"), "key"), "shared-bands")
    met = shared.groupBy("node").agg(F.sum("members").alias("met"))
    leaders = shared.join(met, "node").groupBy("key").agg(F.max_by("node", F.struct("met", -F.col("node"))).alias("leader"))
    pairs = shared.join(stored(leaders, "leaders"), "key").where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    links = stored(verified(known, pairs, similarity, size), "links").select("a", "b")
    grouped = stored(components(links), "components")
    placed = shared.join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    apart = stored(placed.join(stored(several, "mixed-bands"), "key").select("node", "component").distinct(), "apart")
    rest = prefix_pairs(known, apart, similarity, size)
    more = stored(verified(known, rest, similarity, size), "links").select("a", "b")
    # late links connect whole components: only their roots go through the rounds again
    late = stored(components(_rooted(_rooted(more, "a", grouped), "b", grouped)), "late-components").withColumnsRenamed({"node": "root", "component": "late"})
    nodes = grouped.unionByName(late.select(F.col("root").alias("node"), F.col("root").alias("component"))).distinct()
    grouped = stored(nodes.join(late, nodes.component == late.root, "left").select("node", F.coalesce("late", "component").alias("component")), "components")
    classes = firsts.join(grouped, "node", "left").select("ident", F.coalesce("component", "node").alias("class_id"))
    of = sketched.select("doc_id", "ident").join(classes, "ident").groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    return docs.select("doc_id").join(of, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))
