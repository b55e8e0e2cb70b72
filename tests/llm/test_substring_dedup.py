import hashlib
import random
import re

from lakeops.llm.substring_dedup import remove_repeated_windows

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window):
    first = {}
    for doc, text in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if doc is not None:
                first[k] = min(first.get(k, doc), doc)
    out = []
    for doc, text in rows:
        w = WORD.findall(text or "")
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i : i + window])] < doc:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    got = remove_repeated_windows(spark.createDataFrame(rows, "doc_id long, text string"), **kw)
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()], key=str)


def corpus(seed, n, vocabulary):
    r = random.Random(seed)
    passage = [f"w{r.randrange(vocabulary)}é" for _ in range(40)]
    rows = []
    for i in range(n):
        w = [f"w{r.randrange(vocabulary)}" for _ in range(r.randrange(0, 60))]
        for _ in range(r.randrange(3)):
            at, cut = r.randrange(len(w) + 1), r.randrange(30)
            w[at:at] = passage[cut : cut + r.randrange(40)]
        rows.append((i, r.choice([" ", "\n", "  \t"]).join(w)))
    return rows


def test_matches_brute_force(spark):
    for seed, vocabulary, work in ((1, 1000, 500), (2, 3, 500), (3, 1000, 1), (4, 2, 1), (5, 4, 3)):
        rows = corpus(seed, 60, vocabulary)
        rows += [(100, rows[3][1]), (101, rows[3][1]), (101, rows[5][1]), (5, rows[3][1]), (102, None), (103, ""), (None, rows[3][1]), (104, "a " * 300), (105, "a " * 300), (5, rows[5][1])]
        assert run(spark, rows, window=10, mmer=3, work=work) == brute(rows, 10)


def test_production_window_and_separators(spark):
    long = " ".join(f"x{i}" for i in range(500))
    rows = [(3, long), (1, "\n".join(f"x{i}" for i in range(100, 200))), (2, "q " + " ".join(f"x{i}" for i in range(160, 230)))]
    assert run(spark, rows) == brute(rows, 50)


def parity_words(letters):
    """Two words whose letters follow the parity of the bits of their places: sums over powers of a base modulo 2^64 can't tell them apart."""
    return ["".join("ab"[(bin(i).count("1") + flip) & 1] for i in range(letters)) for flip in (0, 1)]


def test_different_long_words_are_different(spark):
    for letters in (1024, 4096):
        a, b = parity_words(letters)
        rows = [(1, " ".join([a, b] * 30)), (2, " ".join([b, b, a] * 20)), (3, " ".join([a, a, a, b] * 15)), (4, " ".join([a, b] * 30))]
        got = run(spark, rows)
        assert got == brute(rows, 50) and [g[2] for g in got] == [0, 0, 0, 60]


def test_a_passage_in_many_different_texts(spark):
    r = random.Random(6)
    passage = [f"p{i}" for i in range(52)]
    rows = [(i, " ".join([f"q{r.randrange(10**6)}" for _ in range(r.randrange(40))] + passage + [f"q{r.randrange(10**6)}" for _ in range(r.randrange(40))])) for i in range(120)]
    assert run(spark, rows, work=7) == brute(rows, 50)


def test_empty_table_and_extra_columns(spark):
    assert remove_repeated_windows(spark.createDataFrame([], "doc_id long, text string, copy string, spans int")).count() == 0
    assert remove_repeated_windows(spark.createDataFrame([(1, "a b", "x", 1)], "doc_id long, text string, copy string, spans int")).first().n_words == 2
