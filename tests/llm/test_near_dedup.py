import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from lakeops.llm.near_dedup import components, near_duplicate_classes, signatures

WORD = re.compile("[^\x20\x09-\x0d]+")


def bag(text):
    w = WORD.findall(text or "")
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows, similarity=0.8):
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    bags = [(i, bag(t)) for i, t in rows]
    for n, (i, a) in enumerate(bags):
        for j, b in bags[:n]:
            if a and b and sum((a & b).values()) >= (similarity - 1e-9) * sum((a | b).values()):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i, _ in rows}


def test_classes_match_brute_force(spark):
    r = random.Random(5)
    rows = []
    for g in range(12):
        base = [f"v{r.randrange(5000)}" for _ in range(r.choice([3, 6, 80, 300]))]
        for _ in range(r.randrange(1, 9)):
            w = list(base)
            for _ in range(r.randrange(0, 4)):
                w[r.randrange(len(w))] = f"e{r.randrange(9999)}"
            rows.append((len(rows) * 3 + g, " ".join(w)))
    rows += [(900, rows[4][1]), (901, rows[4][1].replace(" ", "\n")), (902, None), (903, ""), (904, " \t"), (905, "a " * 400), (906, "a " * 390), (907, "a " * 200), (908, "one"), (909, "one")]
    r.shuffle(rows)
    got = near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {x.doc_id: x.class_id for x in got.collect()} == brute(rows)


def test_different_long_words_are_different(spark):
    for letters in (1024, 4096):
        a, b = ("".join("ab"[(bin(i).count("1") + flip) & 1] for i in range(letters)) for flip in (0, 1))
        rows = [(1, a), (2, b), (3, " ".join([a, b] * 8)), (4, " ".join([b, a] * 8)), (5, " ".join([b, a, a, b] * 4)), (6, a)]
        got = near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"))
        assert {x.doc_id: x.class_id for x in got.collect()} == brute(rows)


def test_equal_hashes_of_different_words_do_not_link(monkeypatch):
    from lakeops.llm import near_dedup

    monkeypatch.setattr(near_dedup, "hash_runs", lambda values, size: np.zeros(max(0, len(values) - size + 1), np.uint64))
    texts = [("a b c d e f", "g h i j k l"), ("a b c d e f", "a b c d e f"), ("a b c d e f g", "a b c d e f h"), ("x", "y"), ("x", "x")]
    batch = pa.RecordBatch.from_pylist([{"a": 1, "b": 2, "text_a": x, "text_b": y} for x, y in texts])
    (got,) = near_dedup._overlaps(5)([batch])
    assert np.allclose(got.column(2).to_pylist(), [0, 1, 0.5, 0, 1])


def test_many_variants_of_one_text(spark):
    r = random.Random(8)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.randrange(0, 9)):
            w[r.randrange(len(w))] = f"e{r.randrange(9999)}"
        rows.append((i, " ".join(w)))
    got = near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute(rows)
    assert {x.doc_id: x.class_id for x in got.collect()} == want and 10 < len(set(want.values())) < 140


def test_register_agreement_is_the_weighted_jaccard_similarity():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 7, 200), r.integers(0, 7, 200)
    doc, shingle, weight = [], [], []
    for d, w in enumerate((a, b)):
        doc += [d] * int((w > 0).sum())
        shingle += np.flatnonzero(w).tolist()
        weight += w[w > 0].tolist()
    s = signatures(np.array(doc), np.array(shingle, np.uint64), np.array(weight), 2, 4096)
    assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (105, 100), (7, 7)] + [(200, 200 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 105: 100, **{200 + i: 200 for i in range(30)}}


def test_empty_table_repeated_rows_and_extra_columns(spark):
    assert near_duplicate_classes(spark.createDataFrame([], "doc_id long, text string, node int")).count() == 0
    rows = [(2, "a b c d e f", 1), (2, "a b c d e f", 2), (1, "a b c d e f", 3), (None, "a b c d e f", 4)]
    got = near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string, node int")).collect()
    assert sorted([(r.doc_id or 0, r.class_id or 0, r.kept) for r in got]) == [(0, 0, True), (1, 1, True), (2, 1, False), (2, 1, False)]
