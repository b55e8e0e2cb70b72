"""Importance resampling towards a target distribution: n-gram weights from arrays, the draw by distributed quickselect.

Weights. A text's features are its runs of 1 to ``WIDEST`` words, hashed (CRC-32) into ``BUCKETS`` buckets. Counts of the buckets over all documents and over
all target texts give each bucket a gain; a document's weight is the sum of its features' gains, looked up in one array. The CRC of a run of words
follows from the CRCs of its words, as appending bytes is linear; so each byte is read once, whatever the runs are.

Draw. A random number of a document's own (from its id) is added to its weight in logarithms, and the documents with the highest sums are drawn, which is drawing without
replacement by weight. The k-th of them is found by quickselect: random pivot keys, exact counts of the rows below, at and above them, and on with the
rows between the two pivots around the k-th, until ``FEW`` or less are left. Keys are (score, doc_id, row), so no two are equal.
Only rows up to the k-th key are sorted: in ranges, each of which numbers its own rows, with the sizes of the ranges before added.

Rows: one per input row. Null texts and texts without a word have no features, weight 0 and are not drawn. A null doc_id counts as an empty one in the hash and
comes last among equal scores; rows that share a doc_id are candidates of their own. Empty documents or an empty target give gains of their counts, as they
are. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.storage import stored
from lakeops.llm.text import Words, per_doc, slices, words

BUCKETS = 10_000
WIDEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
PIVOTS = 32
FEW = 4096

_LONG = 64
#: Upper case to lower case; ASCII signs and controls to spaces.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:0x30] = _PLAIN[0x3A:0x41] = _PLAIN[0x5B:0x61] = _PLAIN[0x7B:0x80] = 0x20
_PLAIN[0x41:0x5B] += 0x20

_ONE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _ONE = np.where(_ONE & 1, (_ONE >> 1) ^ np.uint32(0xEDB88320), _ONE >> 1).astype(np.uint32)


def _append_zero(state: np.ndarray) -> np.ndarray:
    return _ONE[state & 0xFF] ^ (state >> np.uint32(8))


#: States after two bytes.
_TWO = _append_zero(_append_zero(np.arange(1 << 16, dtype=np.uint32)))


def _shifts(most: int) -> np.ndarray:
    """For up to ``most`` zero bytes, each of a state's four bytes and its value: the state after the zeros."""
    state = (np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]).reshape(-1)
    rows = [state]
    for _ in range(most):
        rows.append(_append_zero(rows[-1]))
    return np.concatenate(rows)


_MOST = 255
_SHIFTS = _shifts(_MOST)


def shifted(state: np.ndarray, n: np.ndarray) -> np.ndarray:
    """States after ``n`` more zero bytes."""
    far = np.flatnonzero(n > _MOST)
    if len(far):
        n, state = n.copy(), state.copy()
        while len(far):
            state[far] = _looked_up(state[far], np.full(len(far), _MOST))
            n[far] -= _MOST
            far = far[n[far] > _MOST]
    return _looked_up(state, n)


def _looked_up(state: np.ndarray, n: np.ndarray) -> np.ndarray:
    row = n.astype(np.int32) << 10
    out = _SHIFTS[row | (state & 0xFF)]
    for k in (1, 2, 3):
        out ^= _SHIFTS[row | (k << 8) | ((state >> np.uint32(8 * k)) & 0xFF)]
    return out


def _from_zero(found: Words) -> np.ndarray:
    """The state after each word's bytes from state 0."""
    sizes = found.ends - found.starts
    order = np.argsort(-np.minimum(sizes, _LONG).astype(np.int16), kind="stable")
    starts, n = found.starts[order], sizes[order]
    long = int(np.count_nonzero(n >= _LONG))
    state = np.zeros(len(order), np.uint32)
    data = found.buf.astype(np.uint32)
    for j in range(0, _LONG, 2):
        end = int(np.searchsorted(-n[long:], -j - 2, "right")) + long  # words with two more bytes
        here = slice(long, end)
        if end > long:
            at = starts[here] + j
            state[here] = _TWO[(state[here] & 0xFFFF) ^ data[at] ^ (data[at + 1] << np.uint32(8))] ^ (state[here] >> np.uint32(16))
        odd = slice(end, int(np.searchsorted(-n[long:], -j - 1, "right")) + long)
        if odd.stop > end:
            state[odd] = _append_zero(state[odd] ^ data[starts[odd] + j])
    for i in range(long):
        state[i] = zlib.crc32(found.buf[starts[i] : starts[i] + n[i]]) ^ 0xFFFFFFFF
    if long:
        state[:long] ^= shifted(np.full(long, 0xFFFFFFFF, np.uint32), n[:long])
    out = np.empty_like(state)
    out[order] = state
    return out


def run_hashes(found: Words, widest: int) -> list[np.ndarray]:
    """For each width, the CRC-32 of the run of words that begins at each word, joined by one space; runs may leave their document."""
    own, n = _from_zero(found), found.ends - found.starts
    spaced = own ^ shifted(np.full(len(n), _ONE[0x20], np.uint32), n)
    state = own ^ shifted(np.full(len(n), 0xFFFFFFFF, np.uint32), n)
    out = [~state]
    for width in range(1, widest):
        state = shifted(state[: len(n) - width], n[width:] + 1) ^ spaced[width:] if len(n) > width else state[:0]
        out.append(~state)
    return out


def plain_words(texts: pa.Array) -> Words:
    """Runs of letters and digits of ASCII, in lower case, and of all other signs beyond ASCII."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = _PLAIN[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]] if data is not None else np.zeros(0, np.uint8)
    return words(pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(buf.tobytes())]))


def _features(found: Words, buckets: int, widest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each width, the first words of the runs inside documents, and their buckets."""
    for width, hashes in enumerate(run_hashes(found, widest), 1):
        at = found.windows(width)
        yield at, hashes[at] % np.uint32(buckets)


def _counted(buckets: int, widest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                for _, bucket in _features(plain_words(part.column(0)), buckets, widest):
                    counts += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, widest: int = WIDEST) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket; buckets without any are left out."""
    counts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_counted(buckets, widest), "bucket int, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, from the counts of both."""
    s, t = (np.zeros(buckets) for _ in range(2))
    for counts, into in ((corpus, s), (target, t)):
        for bucket, n in counts.collect():  # a row a bucket
            into[bucket] = n
    all_s, all_t = float(s.sum()) + buckets, float(t.sum()) + buckets
    return np.array([math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def _weighed(gain: np.ndarray, widest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = plain_words(part.column(1))
                of_word = np.zeros(len(found.starts), np.int64)
                features = np.zeros(part.num_rows, np.int64)
                for width, (at, bucket) in enumerate(_features(found, len(gain), widest)):
                    of_word[at] += gain[bucket]
                    features += np.maximum(found.counts - width, 0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.counts), pa.array(features), pa.array(per_doc(of_word, found.first))], ["doc_id", "n_words", "n_features", "weight"])

    return run


def _chance(doc_id: Column, seed: int) -> Column:
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(u)))


_KEY = ("below", "nameless", "id", "row")


def _literal(key: tuple) -> Column:
    below, nameless, doc_id, row = key
    return F.struct(F.lit(below).cast("long"), F.lit(nameless), F.lit(doc_id).cast("long"), F.lit(row).cast("long"))


def kth_key(rows: DataFrame, k: int, n: int, pivots: int = PIVOTS, few: int = FEW) -> tuple:
    """The k-th smallest of the n keys (below, nameless, id, row), which are all different."""
    key = F.struct(*_KEY)
    low = high = None
    for seed in range(10_000):
        inside = rows
        if low is not None:
            inside = inside.where(key > _literal(low))
        if high is not None:
            inside = inside.where(key < _literal(high))
        if n <= few:
            return sorted(tuple(r) for r in inside.select(*_KEY).collect())[k - 1]
        share = -(1 << 63) + min((1 << 64) - 1, ((1 << 64) - 1) * pivots // n)
        chosen = sorted(tuple(r) for r in inside.where(F.xxhash64("row", F.lit(seed)) <= F.lit(share)).select(*_KEY).collect())  # about ``pivots``
        if not chosen:
            continue
        passed = sum(((key > _literal(p)).cast("int") for p in chosen), F.lit(0))
        at = sum(((key == _literal(p)).cast("int") for p in chosen), F.lit(0))
        counts = dict(inside.groupBy((2 * passed + at).alias("slot")).count().collect())
        for slot in range(2 * len(chosen) + 1):
            here = counts.get(slot, 0)
            if k <= here:
                break
            k -= here
        if slot % 2:
            return chosen[slot // 2]
        n = here
        low = chosen[slot // 2 - 1] if slot else low
        high = chosen[slot // 2] if slot // 2 < len(chosen) else high
    raise RuntimeError("no pivot was found")


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with their rank by key: sorted in ranges, which number their rows; the sizes of the ranges before come on top."""
    at = stored(rows.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY).withColumn("at", F.monotonically_increasing_id()), "drawn")
    at = at.withColumn("range", F.shiftright("at", 33).cast("int"))
    sizes = at.groupBy("range").agg(F.count("*").alias("n"))
    before = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))  # a row a range
    return at.join(before, "range").withColumn("rank", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1).drop("at", "range", "before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, widest: int = WIDEST, seed: int = SEED, pivots: int = PIVOTS, few: int = FEW) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every document; percent of those with enough words are drawn."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gain = gains(bucket_counts(texts, buckets, widest), bucket_counts(target, buckets, widest), buckets)
    weighed = texts.mapInArrow(_weighed(gain, widest), "doc_id long, n_words long, n_features long, weight long")
    score = F.col("weight") + _chance(F.col("doc_id"), seed)
    scored = stored(weighed.select("doc_id", "n_words", "n_features", "weight", score.alias("score"), F.monotonically_increasing_id().alias("row")), "scores")
    keyed = scored.select("*", (-F.col("score")).alias("below"), F.col("doc_id").isNull().alias("nameless"), F.coalesce("doc_id", F.lit(0)).alias("id"))
    enough = F.col("n_words") >= least_words
    n = keyed.where(enough).count()
    columns = [F.col(c) for c in ("doc_id", "n_features", "weight", "score")]
    k = n * percent // 100
    if not k:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    last = _literal(kth_key(keyed.where(enough), k, n, pivots, few))
    drawn = enough & (F.struct(*_KEY) <= last)
    winners = ranked(keyed.where(drawn)).select(*columns, "rank")
    return keyed.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")).unionByName(winners)


SQL = r"""
with crc as (
  select list(c order by i) as one from (
    select i, list_reduce([i] || range(8), lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) r(i))),
texts as (
  select false as wanted, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
  union all
  select true, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
runs as (
  select wanted, doc_id, array_to_string(w[i:i + n - 1], ' ') as g
  from (select *, unnest(range(1, len(w) - n + 2)) as i from texts, range(1, 4) r(n) where len(w) >= n)),
counted as (select wanted, doc_id, g, count(*) as n from runs group by all),
bytes as (
  select g, list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::bigint) as b
  from (select g, hex(encode(g)) as h from (select distinct g from counted))),
hashed as (
  select g, (xor(list_reduce([4294967295] || b, lambda c, x: xor(c >> 8, one[(xor(c, x) & 255) + 1])), 4294967295) % 10000)::int as bucket
  from bytes, crc),
features as (select wanted, doc_id, bucket, n from counted join hashed using (g)),
buckets as (select bucket, coalesce(sum(n) filter (not wanted), 0)::double as s, coalesce(sum(n) filter (wanted), 0)::double as t from features group by bucket),
totals as (select sum(s) as all_s, sum(t) as all_t from buckets),
gains as (select bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::bigint as gain from buckets, totals),
weights as (select doc_id, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight from features join gains using (bucket) where not wanted group by doc_id),
scores as (
  select d.doc_id, len(d.w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || d.doc_id), 1, 8))::bigint + 0.5) / 4294967296)))::bigint as score
  from texts d left join weights using (doc_id) where not d.wanted),
placed as (select *, n_words >= 20 as enough, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place from scores)
select doc_id, n_features, weight, score,
  case when enough and place <= (select 5 * count(*) // 100 from scores where n_words >= 20) then place end as rank
from placed
"""
