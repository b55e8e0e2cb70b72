"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Fitting. At most ``SAMPLE`` labelled training rows are the examples (those with the smallest hash of their id; rows that share an id are one example). Together they have at most
``POSTINGS`` different terms, counted in each example; one that would go beyond is left out, so that a few very long texts don't decide the index's size.
Terms are lower-cased letter runs, and every term of an example is in the index; document frequencies are counted over all documents. A term's weight is
(1 + ln tf) * idf * (``BASE`` + G), where G is the log-likelihood ratio between its presence and the label over the examples: the usual
supervised scaling of TF-IDF. Without it the few telling words of a toxic text drown among its other words (the README has figures).
Words that no example has can't match; they count in a text's length with the largest idf.

Index. Terms in many examples are kept as whole rows of weights. Of the others, the examples lie in blocks of ``BLOCK``, similar ones side by side; each such term has its postings, cut by block, and the largest
weight in each block. A query adds up the largest weights to bounds and scores the ``FIRST`` blocks with the largest ones; of the rest it scores all blocks
whose bound reaches the ``NEIGHBOURS``-th best cosine so far, so the result is exact.

Scores. Each neighbour votes for its label with weight 1 / (1 - cosine + SOFT); ``PRIOR`` votes at the examples' base rate keep the score
calibrated (a test measures it). The evidence are the best neighbours' ids.

Rows: one per input row. Null and wordless texts get the base rate, and so does every text where nothing could be learned. Repeated rows
get equal scores. Ties between examples fall to the one that stands first in the index. The index grows with the examples alone and is broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.language_id import held_out
from lakeops.llm.storage import bounded_sample, stored
from lakeops.llm.text import slices

SAMPLE = 4096
POSTINGS = 1 << 21
BASE = 3.0
BLOCK = 64
FIRST = 4
#: Terms in more than this part of the examples are kept whole.
COMMON = 16
_TOGETHER = 256
NEIGHBOURS = 15
SOFT = 0.1
PRIOR = 2.0

_find = re.compile(r"[^\W\d_]+").findall


def terms_of(text: str | None) -> Counter:
    return Counter(_find(text.lower())) if text else Counter()


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, toxic, text) to the terms of the text, in order, with their counts."""
    for batch in batches:
        for part in slices(batch):
            rows = [sorted(terms_of(t).items()) for t in part.column(2).to_pylist()]
            lists = [pa.array([[x[i] for x in r] for r in rows], pa.list_(t)) for i, t in enumerate((pa.string(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], ["doc_id", "toxic", "terms", "times"])


def _vectors(shared):
    """Texts to numbers and counts of the vocabulary's terms, and ``rest``, the sum of (1 + ln tf)^2 over all other terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            for part in slices(batch):
                terms, times, rest = [], [], []
                for text in part.column(2).to_pylist():
                    found = terms_of(text)
                    places = np.array([number.get(t, -1) for t in found], np.int64)
                    counts = np.array(list(found.values()), np.int64)
                    order = np.argsort(places)[np.count_nonzero(places < 0) :]
                    terms.append(places[order].astype(np.int32))
                    times.append(counts[order].astype(np.int32))
                    other = np.log(np.sort(counts[places < 0])) + 1
                    rest.append(float(other @ other))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32())), pa.array(rest)], ["doc_id", "held_out", "terms", "times", "rest"])

    return run


def likelihood_ratio(toxic: np.ndarray, uses: np.ndarray, bad: int, n: int) -> np.ndarray:
    """G statistic of each term's presence (``uses`` of ``n`` examples, ``toxic`` of ``bad`` toxic ones) against the label."""

    def fit(k: np.ndarray, of: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(k > 0, k * np.log(k / of), 0.0) + np.where(of > k, (of - k) * np.log(1 - k / of), 0.0)

    return np.maximum(0.0, 2 * (fit(toxic, uses) + fit(bad - toxic, n - uses) - fit(np.array(bad), np.array(n))))


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and which range each is from."""
    sizes = ends - starts
    of = np.repeat(np.arange(len(starts)), sizes)
    return starts[of] + np.arange(len(of)) - (np.cumsum(sizes) - sizes)[of], of


class Index:
    """Block-max inverted index of labelled unit vectors."""

    def __init__(self, examples: list[tuple], scale: np.ndarray, other: float = 0.0):
        """examples: (doc_id, label, terms, times); ``scale``: of each term; ``other``: of words outside of the vocabulary."""
        self.scale, self.other = scale, other
        made = [(d, y, *self.weigh(t, n, 0.0)) for d, y, t, n in examples]
        # similar examples side by side: by their heaviest term and its weight
        made = sorted((m for m in made if len(m[2])), key=lambda m: (int(m[2][m[3].argmax()]), -float(m[3].max()), m[0]))
        self.rate = sum(e[1] for e in examples) / len(examples) if examples else 0.0
        self.ids = [m[0] for m in made]
        self.labels = np.array([m[1] for m in made], float)
        self.blocks = -(-len(made) // BLOCK)
        term = np.concatenate([m[2] for m in made] or [np.zeros(0, np.int64)])
        place = np.repeat(np.arange(len(made)), [len(m[2]) for m in made])
        weight = np.concatenate([m[3] for m in made] or [np.zeros(0)])
        # terms in many examples are kept whole, a weight for each example, and are always scored: the bounds need only cover the rest
        many = np.flatnonzero(np.bincount(term, minlength=len(scale)) * COMMON > max(COMMON, len(made)))
        self.row = np.full(len(scale), -1)
        self.row[many] = np.arange(len(many))
        self.whole = np.zeros((len(many), self.blocks * BLOCK))
        common = self.row[term] >= 0
        self.whole[self.row[term[common]], place[common]] = weight[common]
        term, place, weight = term[~common], place[~common], weight[~common]
        order = np.lexsort((place, term))
        term, self.places, self.weights = term[order], place[order], weight[order]
        # a cell is what a term has in a block
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (self.places[1:] // BLOCK != self.places[:-1] // BLOCK)
        heads = np.flatnonzero(new)
        self.cuts = np.append(heads, len(term))
        self.cell_block = self.places[heads] // BLOCK
        self.cell_most = np.maximum.reduceat(self.weights, heads) if len(heads) else np.zeros(0)
        self.cells = np.searchsorted(term[heads], np.arange(len(scale) + 1))

    def weigh(self, terms: list[int], times: list[int], rest: float) -> tuple[np.ndarray, np.ndarray]:
        """The terms and their weights in the unit vector."""
        at = np.array(terms, np.int64)
        w = (1 + np.log(np.array(times, float))) * self.scale[at]
        norm = np.sqrt(w @ w + rest * self.other * self.other)
        return at, w / norm if norm else w

    def begin(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """For each query, its sums over the terms that are kept whole."""
        dense = np.zeros((len(queries), len(self.whole)))
        for q, (at, w) in zip(dense, queries, strict=True):
            row = self.row[at]
            q[row[row >= 0]] = w[row >= 0]
        return dense @ self.whole

    def nearest(self, at: np.ndarray, w: np.ndarray, sums: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """The k most similar examples, as (number, cosine), best first; ``sums``: of the terms that are kept whole."""
        at, w = at[self.row[at] < 0], w[self.row[at] < 0]
        cell, of = _spread(self.cells[at], self.cells[at + 1])
        block, w = self.cell_block[cell], w[of]
        bounds = sums.reshape(self.blocks, BLOCK).max(1) + np.bincount(block, weights=w * self.cell_most[cell], minlength=self.blocks)

        def score(chosen: np.ndarray) -> None:
            mine = chosen[block]
            posting, of = _spread(self.cuts[cell[mine]], self.cuts[cell[mine] + 1])
            sums[:] += np.bincount(self.places[posting], weights=self.weights[posting] * w[mine][of], minlength=len(sums))

        first = np.zeros(self.blocks, bool)
        first[np.argsort(-bounds, kind="stable")[:FIRST]] = True
        score(first)
        n, k = len(self.ids), min(k, len(self.ids))
        least = np.partition(sums[:n], n - k)[n - k]
        rest = ~first & (bounds >= least - 1e-9)
        if rest.any():
            score(rest)
        cosines = np.round(sums[:n], 9)
        best = np.flatnonzero(cosines >= np.partition(cosines, n - k)[n - k])
        best = best[np.lexsort((best, -cosines[best]))[:k]]
        return best, cosines[best]

    def scores(self, queries: list[tuple[list[int], list[int], float]]) -> Iterator[tuple[float, list[int]]]:
        """Score and evidence of each (terms, times, rest)."""
        for start in range(0, len(queries), _TOGETHER):
            units = [self.weigh(*q) for q in queries[start : start + _TOGETHER]]
            for (at, w), sums in zip(units, self.begin(units), strict=True):
                if not len(at) or not self.ids:
                    yield self.rate, []
                    continue
                numbers, cosines = self.nearest(at, w, sums)
                votes = 1 / (1 - np.minimum(cosines, 1) + SOFT)
                yield float((votes @ self.labels[numbers] + PRIOR * self.rate) / (votes.sum() + PRIOR)), [self.ids[i] for i in numbers[:3].tolist()]


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            got = list(index.scores(list(zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True))))
            score = np.clip(np.array([g[0] for g in got], float), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array([g[1] for g in got], pa.list_(pa.int64()))], ["doc_id", "held_out", "score", "predicted", "evidence"])

    return run


def _within(examples: DataFrame, postings: int) -> DataFrame:
    """The examples, in the order of their hashes, whose terms fit into what those before have left."""
    kept, left = [], postings
    sizes = examples.select("doc_id", F.size("terms").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()  # a row an example
    for doc, n in sizes:
        if n <= left:
            kept.append((doc,))
            left -= n
    return examples if len(kept) == len(sizes) else examples.join(F.broadcast(examples.sparkSession.createDataFrame(kept, "doc_id long")), "doc_id")


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, postings: int = POSTINGS) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence (ids of the nearest examples) of every row of ``docs``; ``labels`` has doc_id and toxic."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # labels without a document are no examples; at most `sample` small rows: broadcast, so that no text is shuffled
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = stored(bounded_sample(known.withColumn("order", F.xxhash64("doc_id")), "order", sample).select("doc_id", "toxic"), "chosen-labels")
    texts = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    examples = stored(texts.mapInArrow(_words, "doc_id long, toxic int, terms array<string>, times array<int>"), "examples")
    examples = _within(examples, postings)
    # the examples, and the vocabulary of their terms, are bounded by `sample` and `postings` and come to the driver
    uses = examples.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("uses")).toArrow().sort_by("term")
    terms = uses.column("term").to_pylist()
    table = examples.orderBy("doc_id").toArrow().combine_chunks()
    ends = np.cumsum(np.asarray(pc.list_value_length(table.column("terms"))))
    numbers, times = pc.index_in(pc.list_flatten(table.column("terms")), uses.column("term").combine_chunks()).to_numpy(), pc.list_flatten(table.column("times")).to_numpy()
    rows = list(zip(table.column("doc_id").to_pylist(), table.column("toxic").to_pylist(), np.split(numbers, ends[:-1]), np.split(times, ends[:-1]), strict=True)) if len(ends) else []
    shared = spark.sparkContext.broadcast(terms)
    vectors = stored(docs.mapInArrow(_vectors(shared), "doc_id long, held_out boolean, terms array<int>, times array<int>, rest double"), "term-vectors")
    n, found = vectors.count(), np.zeros(len(terms))
    counted = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    found[counted.column("term").to_numpy()] = counted.column("count").to_numpy()
    bad = sum(y for _, y, _, _ in rows)
    told = likelihood_ratio(uses.column("toxic").to_numpy().astype(float), uses.column("uses").to_numpy().astype(float), bad, len(rows))
    scale = (np.log((n + 1) / (found + 1)) + 1) * (BASE + told)
    index = spark.sparkContext.broadcast(Index(rows, scale, (np.log(n + 1) + 1) * BASE))
    return vectors.mapInArrow(_scores(index), "doc_id long, held_out boolean, score double, predicted int, evidence array<long>")
