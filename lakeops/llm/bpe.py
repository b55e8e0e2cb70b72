"""Byte-level BPE by a global distinct-word shuffle.

1. Documents are cut into pre-tokens (words) in packs of ``PACK_BYTES`` of text. A pack's distinct words are dealt to buckets by hash and
   travel as one packed string a bucket; the pack's sequence of word numbers (the positions) stays packed beside them.
2. A bucket, one task, sees each distinct word of the whole table, however many packs and documents have it, and encodes it once. A
   word in every document costs a few bytes a pack, so it makes no task larger than others.
3. The ids of a pack's words come back to the pack, join the token-byte table (one row a rank, a fixed size), and replace the word
   numbers in order of position.

Rows: one per input row, whatever doc_id is. A null text is an empty one, with no tokens. Columns besides doc_id and text are
ignored. Memory: a pack or one longer document; a bucket's known words are forgotten after ``KNOWN`` of them, at the price of
encoding some again.

The documents are read twice, once for the words and once for the positions: storing the words and positions instead would take more disk than
the texts themselves. Both readings must give a partition's rows in the same order, as files do; other inputs are sorted within
their partitions (``stable``). A digest of the words makes sure of it.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.storage import stored
from lakeops.llm.text import slices

PACK_BYTES = 16 << 20
KNOWN = 2_000_000
#: Words that are merged side by side.
TOGETHER = 50_000
#: From this length on, merges are kept in a heap.
LONG = 64
_NEVER = 1 << 40


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line has a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merges the adjacent pair of the lowest rank, the leftmost first, until no pair has a rank."""
    if word in ranks:
        return [ranks[word]]
    if len(word) >= LONG:
        return _encode_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    rank = [ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
    while rank:
        best, at = None, -1
        for i, r in enumerate(rank):
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del rank[at]
        if at:
            rank[at - 1] = ranks.get(parts[at - 1] + parts[at])
        if at < len(rank):
            rank[at] = ranks.get(parts[at] + parts[at + 1])
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(word)
    ends, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (r := ranks.get(word[i : ends[j]])) is not None:
            heapq.heappush(heap, (r, i, ends[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i] if ends[i] else n
        if j >= n or ends[j] != end:
            continue  # one of the two has merged meanwhile
        ends[i], ends[j] = end, 0
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[word[i : ends[i]]] for i in range(n) if ends[i]]


class Merges:
    """All pairs of tokens that make a token, for merging many words side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = sorted((ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.made = np.array([r for _, r in pairs] or [0], np.int64)
        self.single = np.array([ranks.get(bytes((i,)), -1) for i in range(256)], np.int64)
        self.ranks = ranks

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], _NEVER)

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word: the adjacent pair of the lowest rank merges, the leftmost first, until no pair has a rank."""
        out: list = [None] * len(words)
        rest = []
        for i, w in enumerate(words):
            if (rank := self.ranks.get(w)) is not None:
                out[i] = np.array([rank], "<u4")
            elif len(w) >= LONG:
                out[i] = np.array(_encode_long(w, self.ranks), "<u4")
            else:
                rest.append(i)
        for start in range(0, len(rest), TOGETHER):
            self._merge(rest[start : start + TOGETHER], words, out)
        return out

    def _merge(self, numbers: list[int], words: list[bytes], out: list) -> None:
        owner = np.array(numbers)
        sizes = np.array([len(words[i]) for i in numbers])
        token = self.single[np.frombuffer(b"".join([words[i] for i in numbers]), np.uint8)]
        rank = np.full(len(token), _NEVER)
        rank[:-1] = self._rank(token[:-1], token[1:])
        while len(owner):
            heads = np.cumsum(sizes) - sizes
            rank[heads + sizes - 1] = _NEVER
            best = np.minimum.reduceat(rank, heads)
            done = best == _NEVER
            if done.any():
                for i, a, b in zip(owner[done].tolist(), heads[done].tolist(), (heads + sizes)[done].tolist(), strict=True):
                    out[i] = token[a:b].astype("<u4")
                left = np.repeat(~done, sizes)
                token, rank, owner, sizes, best = token[left], rank[left], owner[~done], sizes[~done], best[~done]
                if not len(owner):
                    break
            heads = np.cumsum(sizes) - sizes
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            at = hits[np.searchsorted(hits, heads)]  # the leftmost of each word
            token[at] = best
            kept = np.ones(len(token), bool)
            kept[at + 1] = False
            at -= np.arange(len(at))  # places after the second halves have gone
            token, rank = token[kept], rank[kept]
            sizes = sizes - 1
            for i in (at, at[at > 0] - 1):
                i = i[i + 1 < len(token)]
                rank[i] = self._rank(token[i], token[i + 1])


def _pack(words: list[bytes]) -> bytes:
    return zlib.compress(np.array([len(w) for w in words], "<u4").tobytes() + b"".join(words), 1)


def _unpack(packed: bytes, n: int) -> list[bytes]:
    data = zlib.decompress(packed)
    ends = np.cumsum(np.frombuffer(data, "<u4", n)).tolist()
    data = data[4 * n :]
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _packs(pattern: str, buckets: int, batches: Iterator[pa.RecordBatch]):
    """Number, rows, distinct words by bucket, the words' counts, and the sequence of word numbers with the documents' lengths."""
    import regex

    find = regex.compile(pattern).findall
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, most=PACK_BYTES, rows=1 << 16):
            known: dict[str, int] = defaultdict()
            known.default_factory = known.__len__
            sequence = [np.array(list(map(known.__getitem__, find(text))) if text else [], np.uint32) for text in part.column(1).to_pylist()]
            lengths = list(map(len, sequence))
            sequence = np.concatenate(sequence)
            words = [w.encode() for w in known]
            counts = np.bincount(sequence, minlength=len(words))
            bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
            order = np.lexsort((-counts, bucket))
            words, counts = [words[i] for i in order.tolist()], counts[order]
            place = np.empty(len(words), np.uint32)
            # the most frequent words have the smallest numbers; the counts by bucket, which travel too, tell which they are
            place[order[_by_count(counts)]] = np.arange(len(words), dtype=np.uint32)
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
            yield number, part, words, cuts, counts, place[sequence], lengths
            number += 1


def _by_count(counts: np.ndarray) -> np.ndarray:
    return np.argsort(-counts, kind="stable")


def _planes(values: np.ndarray) -> list[bytes]:
    """The bytes of whole numbers in planes, which compress."""
    return [zlib.compress((values >> s).astype(np.uint8).tobytes(), 1) for s in (0, 8, 16, 24)]


def _joined(planes: list[bytes]) -> np.ndarray:
    return sum(np.frombuffer(zlib.decompress(p), np.uint8).astype(np.int64) << s for p, s in zip(planes, (0, 8, 16, 24), strict=True))


def _words(pattern: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, words, cuts, *_ in _packs(pattern, buckets, batches):
            rows = [(number, b, cuts[b + 1] - cuts[b], _pack(words[cuts[b] : cuts[b + 1]])) for b in range(buckets) if cuts[b + 1] > cuts[b]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["pack", "bucket", "n", "packed"])

    return run


def _digest(words_in_bucket: list[bytes]) -> int:
    return zlib.crc32(b"\0".join(words_in_bucket))


def _positions(pattern: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part, words, cuts, counts, sequence, lengths in _packs(pattern, buckets, batches):
            digests = [_digest(words[cuts[b] : cuts[b + 1]]) for b in range(buckets)]
            row = (number, -1, len(words), part.column(0).to_pylist(), lengths, digests, _planes(counts), _planes(sequence))
            types = (pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 3, *[pa.list_(pa.binary())] * 2)
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, types, strict=True)], ["pack", "bucket", "n", "doc_ids", "lengths", "digests", "counts", "sequence"])

    return run


def _encode(merges):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = merges.value, {}
        for batch in batches:
            out = []
            for number, bucket, n, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = _unpack(packed, n)
                new = [w for w in words if w not in known]
                if len(known) + len(new) > KNOWN:
                    known.clear()
                    new = words
                known.update(zip(new, [ids.tobytes() for ids in table.encode(new)], strict=True))
                ids = [known[w] for w in words]
                flat = np.frombuffer(b"".join(ids), "<u4")
                sizes = np.fromiter(map(len, ids), np.int64, n) >> 2
                out.append((number, bucket, n, _digest(words), _planes(sizes), _planes(flat)))
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, types, strict=True)], ["pack", "bucket", "n", "digest", "sizes", "ids"])

    return run


def _reassemble(tokens, ids_too: bool):
    def run(table: pa.Table) -> pa.Table:
        byte = tokens.value
        rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
        head = rows[0]
        if sum(r["n"] for r in rows[1:]) != head["n"] or any(r["digest"] != head["digests"][r["bucket"]] for r in rows[1:]):
            raise ValueError("the rows of the documents came in another order when they were read again; pass stable=False")
        sequence = _by_count(_joined(head["counts"]))[_joined(head["sequence"])]
        sizes = np.concatenate([_joined(r["sizes"]) for r in rows[1:]] or [np.zeros(0, np.int64)])
        flat = np.concatenate([_joined(r["ids"]) for r in rows[1:]] or [np.zeros(0, np.int64)]).tolist()
        ends = np.cumsum(sizes).tolist()
        texts, decoded = [], []
        for a, b in zip([0, *ends], ends, strict=False):
            ids = flat[a:b]
            texts.append(",".join(map(str, ids)))
            decoded.append(b"".join([byte[i] for i in ids]))
        out = {k: [] for k in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")} | ({"ids": []} if ids_too else {})
        start = 0
        for doc, k in zip(head["doc_ids"], head["lengths"], strict=True):
            of = sequence[start : start + k]
            numbers = of.tolist()
            start += k
            joined = ",".join([texts[i] for i in numbers])
            out["doc_id"].append(doc)
            out["n_tokens"].append(int(sizes[of].sum()))
            out["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(b"".join([decoded[i] for i in numbers])).hexdigest())
            if ids_too:
                out["ids"].append([int(i) for i in joined.split(",")] if joined else [])
        fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + ([("ids", pa.list_(pa.int32()))] if ids_too else [])
        return pa.table(out, schema=pa.schema(fields))

    return run


def encode_documents(docs: DataFrame, path: str, pattern: str, ids: bool = False, buckets: int | None = None, stable: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids themselves of every row's whole text.

    ``path``: a rank file; ``pattern``: what cuts text into pre-tokens; ``buckets``: of words, by default the number of shuffle partitions;
    ``stable``: whether the rows of a partition come in the same order whenever they are read, as those of files do."""
    spark = docs.sparkSession
    buckets = buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranks = load_ranks(path)
    merges = spark.sparkContext.broadcast(Merges(ranks))
    tokens = spark.sparkContext.broadcast({i: t for t, i in ranks.items()})
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    docs = docs if stable else docs.sortWithinPartitions("doc_id", "text")
    words = docs.mapInArrow(_words(pattern, buckets), "pack long, bucket int, n int, packed binary").repartition(buckets, "bucket")
    encoded = words.mapInArrow(_encode(merges), "pack long, bucket int, n int, digest long, sizes array<binary>, ids array<binary>")
    positions = docs.mapInArrow(_positions(pattern, buckets), "pack long, bucket int, n int, doc_ids array<long>, lengths array<long>, digests array<long>, counts array<binary>, sequence array<binary>")
    both = positions.unionByName(encoded, allowMissingColumns=True)
    return both.groupBy("pack").applyInArrow(_reassemble(tokens, ids), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else ""))


def token_bytes(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """The token-byte table: id and hex digits of the bytes."""
    return spark.createDataFrame(pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": pa.array([t.hex() for t in ranks], pa.string())}))


def _spelled(ids: DataFrame, key: str, tokens: DataFrame) -> DataFrame:
    """key, and ``spelled``: the (at, id, hex) of each of its ``ids`` in order."""
    each = ids.select(key, F.posexplode("ids").alias("at", "id")).join(tokens, "id")
    return each.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "id", "hex"))).alias("spelled"))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the bytes of ``ids``, joined with the token-byte table; null ids are empty. An id without a row in the table raises an error."""
    rows = stored(encoded.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")), "encoded-rows")
    spelled = _spelled(rows, "row", token_bytes(encoded.sparkSession, load_ranks(path)))
    whole = F.coalesce(F.size("spelled"), F.lit(0)) == F.size("ids")
    text = F.when(whole, F.coalesce(F.array_join("spelled.hex", ""), F.lit(""))).otherwise(F.raise_error(F.lit("an id without a row in the token-byte table")).cast("string"))
    return rows.join(spelled, "row", "left").select("doc_id", F.unhex(text).alias("bytes"))
