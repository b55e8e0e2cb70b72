import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm.hard_negatives import grow, mine, usable


def brute(rows, every, positives=5, negatives=5, low=80, high=100, scale=1):
    part = []
    for vec_id, label, v in rows:
        if vec_id is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            part.append((vec_id, label, [math.floor(scale * x) for x in v]))
    out = Counter()
    for i, (a, label, v) in enumerate(part):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), b, of) for j, (b, of, w) in enumerate(part) if j != i]
        for s, b, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            hard = sorted(x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s)[:negatives]
            out.update((a, b, rank, c, -s, -t) for rank, (t, c, _) in enumerate(hard, 1))
    return out


def vectors(seed, n, width, spread):
    r = random.Random(seed)
    centres = [[r.gauss(0, 3) for _ in range(width)] for _ in range(4)]
    return [(i, r.randrange(3), [x + r.gauss(0, spread) for x in r.choice(centres)]) for i in range(n)]


SCHEMA = "vec_id long, label int, embedding array<double>"


@pytest.mark.parametrize("width,spread,small", [(3, 0.2, {}), (3, 0.2, dict(leaf=8, fan=3, part=5, block=2)), (8, 1.0, dict(leaf=20, fan=4, part=16, block=3, sample=100)), (1, 2.0, dict(leaf=10, fan=2))])
def test_matches_brute_force(spark, width, spread, small):
    rows = vectors(width, 300, width, spread)
    rows += [(i, 1, rows[0][2]) for i in range(300, 360)] + [(400, None, rows[1][2]), (405, 2, None), (410, 2, [None] * width), (415, 2, [math.nan] * width), (420, 0, [-math.inf] * width), (None, 1, rows[2][2])]
    rows += [rows[5]] * 3 + [(425, 1, [0.0] * width), (430, 1, [])]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", row int, leaf string, part int").repartition(3)
    got = mine(usable(frame, "embedding", 16), F.col("vec_id") % 5 == 0, **small)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, 5, scale=16)


def test_few_rows_and_none(spark):
    assert mine(usable(spark.createDataFrame([], SCHEMA), "embedding"), F.col("vec_id") % 5 == 0).count() == 0
    rows = [(0, 1, [2.0, 1.0]), (1, 1, [2.0, 0.0]), (2, 0, [1.0, 2.0]), (3, 0, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert Counter(tuple(r) for r in mine(usable(frame, "embedding"), F.col("vec_id") == 0, leaf=1, fan=2).collect()) == Counter([(0, 1, 1, 2, 4, 4)])
    assert mine(usable(frame, "embedding"), F.lit(False)).count() == 0


def test_large_components(spark):
    rows = [(0, 1, [2.0**24, 3.0]), (1, 1, [2.0**24, 5.0]), (2, 0, [2.0**24, 1.0]), (3, 0, [2.0**24, 4.0])]
    got = mine(usable(spark.createDataFrame(rows, SCHEMA), "embedding"), F.col("vec_id") == 0).collect()
    assert [(r.negative_id, r.negative_score) for r in sorted(got, key=lambda r: r["rank"])] == [(3, 2**48 + 12), (2, 2**48 + 3)]
    with pytest.raises(Exception, match="63 bits"):
        mine(usable(spark.createDataFrame([(0, 1, [2.0**40] * 4), (1, 1, [2.0**40] * 4)], SCHEMA), "embedding"), F.col("vec_id") == 0).collect()


def test_siblings_are_eliminated():
    """In three dimensions most leaves lie outside an anchor's annulus, and none that holds a row of it."""
    r = np.random.default_rng(3)
    x = np.floor(r.normal(size=(4000, 3)) * 100)
    reach = float(np.sqrt((x**2).sum(1).max()))
    tree = grow(x[:1000], len(x), reach, leaf=50, fan=4)
    for points in tree.points:
        tree.least.append(np.full((len(points),) * 2, np.inf))
        tree.most.append(np.full((len(points),) * 2, -np.inf))
    for node, _, to, away in tree.descend(x):
        for j in np.unique(to):
            tree.least[node][:, j], tree.most[node][:, j] = away[to == j].min(0), away[to == j].max(0)
    leaf = tree.leaf_of(x)
    assert tree.leaves > 50 and len(np.unique(leaf)) > 40
    anchors = x[:40]
    scores = anchors @ x.T
    high = np.sort(scores, axis=1)[:, -5]
    low = 0.8 * high
    seen = {i: set() for i in range(40)}
    for at, some in tree.visited(anchors, low[:, None], high[:, None]):
        for i in some:
            seen[i].add(at)
    for i in range(40):
        assert set(leaf[(scores[i] >= low[i]) & (scores[i] <= high[i])]) <= seen[i]
    assert np.mean([len(s) for s in seen.values()]) < 0.5 * tree.leaves
