import hashlib
import math
import random
import re
from collections import defaultdict

import pytest

from lakeops.llm.mixing import mix

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows):
    """(doc_id, text, source) to (size, source_size, target, taken), excess reshared in rounds as the contract says it."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    total = defaultdict(int)
    for (_, _, s), n in zip(rows, size):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(total.values()), set(order)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * total[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
            free.discard(s)
    out = []
    for s in order:
        own = []
        for i, (doc, text, src) in enumerate(rows):
            if src == s:
                u = (int(hashlib.md5(("" if doc is None else str(doc)).encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                text = text or ""
                w = max(1, math.floor(100 - 100 * sum(c in "#*$%&|<>" for c in text) / max(1, len(text))) if rows[i][1] is not None else 0) / 100
                own.append((-math.log(u) / w, doc, size[i]))
        epochs = math.floor(target[s] / max(1, total[s]))
        missing = math.floor(target[s] + 0.5) - epochs * total[s]
        for _, doc, n in sorted(own, key=str if None in [o[1] for o in own] else None):
            extra = max(0, min(n, missing))
            missing -= n
            out.append((doc, n, total[s], target[s], epochs * n + extra))
    return out


def corpus(seed, sources, n):
    r = random.Random(seed)
    return [(i, " ".join(r.choice(["a", "bé", "c#"]) for _ in range(int(r.expovariate(1 / 40)))), r.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("sources,n", [(["a", "a", "a", "a", "b", "c", "d", None], 500), (["x"], 40), (["b", "B", "é", "zz", "a"] + ["k"] * 200, 700)])
def test_matches_brute_force(spark, sources, n):
    rows = corpus(n, sources, n) + [(9000, None, "a"), (9001, "", None), (9002, " \n", "only empty")]
    got = sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    want = sorted(brute(rows))
    assert [(g[0], g[1], g[2], g[4]) for g in got] == [(w[0], w[1], w[2], w[4]) for w in want]
    assert all(abs(g[3] - w[3]) < 1e-6 * max(1, w[3]) for g, w in zip(got, want))
    assert all(g[4] <= 2 * g[1] for g in got)
    taken = defaultdict(int)
    for g, (_, _, s) in zip(got, sorted(rows, key=lambda x: x[0])):
        taken[s] += g[4]
    assert all(abs(taken[s] - g[3]) <= 0.5 + 1e-6 for g, (_, _, s) in zip(got, sorted(rows, key=lambda x: x[0])))


def test_empty_tables_repeated_rows_and_extra_columns(spark):
    schema = "doc_id long, text string, source string, size string, target int, part int"
    assert mix(spark.createDataFrame([], schema)).count() == 0
    assert [r.taken for r in mix(spark.createDataFrame([(1, None, None, "", 1, 1)], schema)).collect()] == [0]
    got = mix(spark.createDataFrame([(1, "a b c d", "s", "", 1, 1)] * 3 + [(None, "e f", "s", "", 2, 2)], schema)).collect()
    assert sum(r.taken for r in got) == 21 and len(got) == 4 and all(r.taken <= 2 * r.size for r in got)
