"""Hard negatives by a multiway hyperplane tree with distance ranges between siblings.

Geometry. Vectors are whole numbers and scores are their inner products. With one more coordinate that brings all rows to one length M (0 for a searching
anchor), distance^2 = |anchor|^2 + M^2 - 2 * score; so scores between two values are rows in an annulus about the anchor.

Index. A tree of split points, ``FAN`` a node, is grown on a bounded sample (the ``SAMPLE`` rows with the smallest hashes; greedily far from each other); it has at most
``LEAVES`` leaves, whatever the table's size. Every row descends to the nearest split point of each node, and lies in one leaf. For each split point i and each subtree j
of a node the smallest and largest distance between i and the rows of j are kept. An anchor at distance d of i has the rows of j between max(d - most, least - d) and d + most;
where that misses all its annuli, j is left out. The subtrees that stay are searched down to their leaves, whose rows are all scored, exactly.

Work. Leaves of many rows are cut into parts, the anchors that visit a leaf into blocks; a task holds one part and one block. What a part finds
is at most the number asked for, and the first ones of all parts are the answer.

1. Anchors search their own leaf for rows of their label. The last score found bounds the annulus of the search over the tree.
2. The first ``positives`` rows of the label.
3. For each positive, the annulus between ``low`` and ``high`` percent of its score, rows of other labels.

Rows with a null vec_id or label, a null vector, or a null or non-finite component take no part. Shorter vectors are filled with zeros. Repeated rows are rows of their own (a
repeated anchor has answers of its own, and the other copies are among its positives); equal scores are in order of vec_id. Anchors without positives or negatives
give no rows, so neither does an empty table. Components so large that scores leave 63 bits are an error. Columns besides vec_id, label and the vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.storage import bounded_sample, stored

SAMPLE = 4096
FAN = 8
LEAVES = 4096
LEAF = 1024
PART = 8192
BLOCK = 4096
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
_TOGETHER = 256


@dataclass
class Tree:
    """Nodes have split points with one more coordinate; a child is a node's number, or -1 - leaf."""

    reach: float
    points: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    least: list[np.ndarray] = field(default_factory=list)
    most: list[np.ndarray] = field(default_factory=list)
    leaves: int = 0

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.reach**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        return np.column_stack((vectors, rest))

    def descend(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each node that rows come to: its number, the rows, the split point each one goes to, and the distances to all of them."""
        lifted = self.lifted(vectors)
        todo = [(0, np.arange(len(lifted)))] if self.points and len(lifted) else []
        while todo:
            node, rows = todo.pop()
            away = np.sqrt(np.maximum(2 * self.reach**2 - 2 * (lifted[rows] @ self.points[node].T), 0))
            to = away.argmin(1)
            yield node, rows, to, away
            for j, child in enumerate(self.children[node]):
                if child >= 0 and len(some := rows[to == j]):
                    todo.append((child, some))

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(vectors), np.int64)
        for node, rows, to, _ in self.descend(vectors):
            leaf[rows] = -1 - np.array(self.children[node])[to]
        return leaf

    def visited(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the anchors that must search them; low and high have the score windows of each anchor in their columns, NaN for none."""
        square = np.einsum("ij,ij->i", anchors, anchors)[:, None] + self.reach**2
        slack = 1e-6 * (np.sqrt(square) + 1)
        outer, inner = np.sqrt(np.maximum(square - 2 * low, 0)) + slack, np.sqrt(np.maximum(square - 2 * high, 0)) - slack
        everyone = np.flatnonzero(~np.isnan(low).all(1))
        todo = [(0, everyone)] if self.points else []
        if not self.points and len(everyone):
            yield 0, everyone
        while todo:
            node, some = todo.pop()
            away = np.sqrt(np.maximum(square[some] - 2 * (anchors[some] @ self.points[node][:, :-1].T), 0))[:, :, None]
            nearest = np.maximum(away - self.most[node], self.least[node] - away).max(1)
            farthest = (away + self.most[node]).min(1)
            meets = ((nearest[:, :, None] <= outer[some][:, None]) & (farthest[:, :, None] >= inner[some][:, None])).any(2)
            for j, child in enumerate(self.children[node]):
                if len(rest := some[meets[:, j]]):
                    if child < 0:
                        yield -1 - child, rest
                    else:
                        todo.append((child, rest))


def grow(sample: np.ndarray, n: int, reach: float, leaf: int = LEAF, fan: int = FAN, leaves: int = LEAVES) -> Tree:
    """A tree for n rows, from a sample of them. Nodes with the most rows are split first, while they are expected to hold more than ``leaf`` of them."""
    tree = Tree(reach)
    lifted = tree.lifted(sample)
    share = n / max(1, len(lifted))
    todo = [(np.arange(len(lifted)), None)]
    tree.leaves = 1
    while todo:
        todo.sort(key=lambda x: len(x[0]))
        rows, place = todo.pop()
        chosen = _far_apart(lifted[rows], fan) if len(rows) * share > leaf and len(rows) >= 2 * fan and tree.leaves + fan <= leaves else []
        if len(chosen) < 2:
            continue
        node = len(tree.points)
        tree.points.append(lifted[rows][chosen])
        if place is None:
            numbers = list(range(len(chosen)))
        else:
            parent, j = place
            numbers = [-1 - tree.children[parent][j], *range(tree.leaves, tree.leaves + len(chosen) - 1)]  # the first child takes the number of the leaf that is split
            tree.children[parent][j] = node
        tree.children.append([-1 - x for x in numbers])
        tree.leaves += len(chosen) - 1
        to = (lifted[rows] @ tree.points[node].T).argmax(1)
        todo += [(rows[to == j], (node, j)) for j in range(len(chosen))]
    return tree


def _far_apart(points: np.ndarray, fan: int) -> list[int]:
    """Up to ``fan`` different points, each the farthest from those before."""
    chosen, away = [0], np.full(len(points), np.inf)
    while len(chosen) < fan:
        away = np.minimum(away, np.linalg.norm(points - points[chosen[-1]], axis=1))
        if away.max() <= 1e-6 * (1 + np.linalg.norm(points[0])):
            break
        chosen.append(int(away.argmax()))
    return chosen


def _vectors(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _leaves(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.value.leaf_of(_vectors(batch.column(batch.schema.get_field_index("vector"))).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], [*batch.schema.names, "leaf"])

    return run


def _ranges(tree):
    """The least and greatest distances of a task's rows by node, split point and subtree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for node, _, to, away in tree.value.descend(_vectors(batch.column(0)).astype(np.float64)):
                k = away.shape[1]
                least, most = found.setdefault(node, (np.full((k, k), np.inf), np.full((k, k), -np.inf)))
                for j in np.unique(to):
                    least[:, j] = np.minimum(least[:, j], away[to == j].min(0))
                    most[:, j] = np.maximum(most[:, j], away[to == j].max(0))
        for node, (least, most) in found.items():
            i, j = np.nonzero(np.isfinite(least))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), node), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(least[i, j]), pa.array(most[i, j])], ["node", "i", "j", "least", "most"])

    return run


def _visits(tree):
    """Anchors with the leaves that their windows reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _TOGETHER):
                part = batch.slice(start, _TOGETHER)
                anchors = _vectors(part.column(part.schema.get_field_index("vector"))).astype(np.float64)
                windows = part.column(part.schema.get_field_index("windows")).to_pylist()
                width = max((len(w) for w in windows), default=0)
                low, high = (np.array([[x[side] for x in w] + [np.nan] * (width - len(w)) for w in windows]).reshape(len(windows), width) for side in ("low", "high"))
                for leaf, some in tree.value.visited(anchors, low, high) if width else ():
                    out = part.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays([*out.columns, pa.array(np.full(len(some), leaf), pa.int32())], [*out.schema.names, "leaf"])

    return run


def _exact(vectors: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products in floating point as long as that is exact, else in whole numbers."""
    most = (float(np.abs(vectors).max(initial=0)) * float(np.abs(anchors).max(initial=0))) * vectors.shape[1]
    if most >= 2.0**62:
        raise ValueError("scores beyond 63 bits")
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    return (anchors.astype(kind) @ vectors.astype(kind).T).astype(np.int64)


def _first(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, among: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` of ``among`` by score, id and row."""
    if len(among) > n:
        among = among[score[among] >= np.partition(score[among], len(among) - n)[len(among) - n]]
    return among[np.lexsort((rows[among], ids[among], -score[among]))][:n]


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return np.asarray(table.column(name))


def _near(n: int):
    """In a part, the first ``n`` other rows of the anchor's label."""

    def run(_, part: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if part.num_rows and block.num_rows:
            vectors, anchors = (_vectors(t.column("vector").combine_chunks()) for t in (part, block))
            ids, labels, rows = (_numbers(part, c) for c in ("vec_id", "label", "row"))
            for start in range(0, len(anchors), _TOGETHER):
                scores = _exact(vectors, anchors[start : start + _TOGETHER])
                for score, row, label in zip(scores, _numbers(block, "row")[start:].tolist(), _numbers(block, "label")[start:].tolist(), strict=False):
                    best = _first(score, ids, rows, np.flatnonzero((labels == label) & (rows != row)), n)
                    out += [(row, i, r, s) for i, r, s in zip(ids[best].tolist(), rows[best].tolist(), score[best].tolist(), strict=True)]
        return _table(out, ("anchor", "found_id", "found_row", "score"))

    return run


def _below(n: int, low: int, high: int):
    """In a part, for each positive of an anchor the first ``n`` rows of other labels in its window."""

    def run(_, part: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if part.num_rows and block.num_rows:
            vectors, anchors = (_vectors(t.column("vector").combine_chunks()) for t in (part, block))
            ids, labels, rows = (_numbers(part, c) for c in ("vec_id", "label", "row"))
            positives = block.column("positives").to_pylist()
            for start in range(0, len(anchors), _TOGETHER):
                scores = _exact(vectors, anchors[start : start + _TOGETHER])
                for score, row, label, sought in zip(scores, _numbers(block, "row")[start:].tolist(), _numbers(block, "label")[start:].tolist(), positives[start:], strict=False):
                    others = np.flatnonzero(labels != label)
                    for p in sought:
                        inside = others[(100 * score[others] >= low * p["score"]) & (100 * score[others] <= high * p["score"])]
                        best = _first(score, ids, rows, inside, n)
                        out += [(row, p["found_row"], i, r, s) for i, r, s in zip(ids[best].tolist(), rows[best].tolist(), score[best].tolist(), strict=True)]
        return _table(out, ("anchor", "positive", "found_id", "found_row", "score"))

    return run


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    return pa.table([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * len(names))], names)


def usable(rows: DataFrame, vector: str, scale: int = 1) -> DataFrame:
    """vec_id, label and the vector in whole numbers (floor of scale * component) of the rows that take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("vector"))


def _searched(rows: DataFrame, visits: DataFrame, find, schema: str, part: int, block: int) -> DataFrame:
    """What ``find`` gives for each part of a leaf and block of its visitors."""
    sizes = rows.groupBy("leaf").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    blocks = visits.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    cut = stored(sizes.join(blocks, "leaf"), "leaf-sizes")  # a row a leaf
    key = ("leaf", "part", "block")
    ours = rows.join(cut, "leaf").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    theirs = visits.join(cut, "leaf").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return ours.drop("parts", "blocks").groupBy(*key).cogroup(theirs.drop("parts", "blocks").groupBy(*key)).applyInArrow(find, schema)


def _best(found: DataFrame, by: tuple[str, ...], n: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "found_id", "found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(
    rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, sample: int = SAMPLE, leaf: int = LEAF, fan: int = FAN, part: int = PART, block: int = BLOCK
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score, from (vec_id, label, vector) as ``usable`` gives them; ``anchor`` tells which rows search."""
    rows = stored(rows.select("vec_id", "label", "vector", F.coalesce(anchor, F.lit(False)).alias("searches"), F.monotonically_increasing_id().alias("row")), "vectors")
    zero = F.lit(0).cast("long")
    facts = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width"), F.coalesce(F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)), F.lit(0.0)).alias("longest")).first()
    rows = rows.withColumn("vector", F.concat("vector", F.array_repeat(zero, F.lit(facts["width"]) - F.size("vector")))) if facts["width"] else rows.withColumn("vector", F.array(zero))
    some = bounded_sample(rows.select("vector", F.xxhash64("row").alias("hash")), "hash", sample).select("vector").toArrow().column(0).combine_chunks()
    tree = grow(_vectors(some).astype(np.float64), facts["n"], float(np.sqrt(facts["longest"])), leaf, fan)
    context = rows.sparkSession.sparkContext
    fixed = "vec_id long, label long, vector array<long>, searches boolean, row long"
    bare = context.broadcast(tree)
    ranges = rows.select("vector").mapInArrow(_ranges(bare), "node int, i int, j int, least double, most double").groupBy("node", "i", "j").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    for points in tree.points:
        tree.least.append(np.full((len(points),) * 2, np.inf))
        tree.most.append(np.full((len(points),) * 2, -np.inf))
    for node, i, j, least, most in ranges.collect():  # at most FAN^2 a node, and LEAVES / (FAN - 1) nodes
        tree.least[node][i, j], tree.most[node][i, j] = least, most
    tree = context.broadcast(tree)
    rows = stored(rows.mapInArrow(_leaves(bare), f"{fixed}, leaf int"), "leaves")
    anchors = rows.where("searches").drop("searches").toDF("vec_id", "label", "vector", "row", "leaf")
    rows = rows.drop("searches")
    found = "anchor long, found_id long, found_row long, score long"
    own = _best(_searched(rows, anchors, _near(positives), found, part, block), ("anchor",), positives)
    bounds = own.groupBy(F.col("anchor").alias("row")).agg(F.min("score").alias("last"), F.count("*").alias("n"))
    least = F.when(F.col("n") >= positives, F.col("last").cast("double")).otherwise(F.lit(float("-inf")))
    window = lambda lo, hi: F.struct(lo.alias("low"), hi.alias("high"))
    seeking = anchors.drop("leaf").join(bounds, "row", "left").select("vec_id", "label", "vector", "row", F.array(window(F.coalesce(least, F.lit(float("-inf"))), F.lit(float("inf")))).alias("windows"))
    kept = "vec_id long, label long, vector array<long>, row long, windows array<struct<low: double, high: double>>"
    visits = stored(seeking.mapInArrow(_visits(tree), f"{kept}, leaf int").drop("windows"), "visits")
    near = stored(_best(_searched(rows, visits, _near(positives), found, part, block), ("anchor",), positives).drop("rank"), "positives")
    of_anchor = near.where("score >= 0").groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("found_row", "score")).alias("positives"))  # at most ``positives``
    edges = F.transform("positives", lambda p: window(p["score"] * (low / 100), p["score"] * (high / 100)))
    seeking = anchors.drop("leaf").join(of_anchor, "row").select("vec_id", "label", "vector", "row", edges.alias("windows"), "positives")
    visits = stored(seeking.mapInArrow(_visits(tree), f"{kept}, positives array<struct<found_row: long, score: long>>, leaf int").drop("windows"), "window-visits")
    hard = _best(_searched(rows, visits, _below(negatives, low, high), "anchor long, positive long, found_id long, found_row long, score long", part, block), ("anchor", "positive"), negatives)
    named = near.select("anchor", F.col("found_row").alias("positive"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    hard = hard.select("anchor", "positive", F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score"), F.col("rank").cast("int").alias("rank")).join(named, ["anchor", "positive"])
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return hard.join(ids, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = r"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, x.vec_id, a.label = x.label as same, list_dot_product(a.v, x.v)::bigint as score
  from v a join v x on a.vec_id % 100 = 0 and a.vec_id <> x.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""
