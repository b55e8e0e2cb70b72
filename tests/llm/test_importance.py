import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from lakeops.llm import importance
from lakeops.llm.importance import bucket_counts, kth_key, plain_words, resample, run_hashes

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(text)
    return len(w), Counter(" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))


def brute(docs, target, percent=5, least=20, buckets=10_000):
    def spread(texts):
        out = Counter()
        for t in texts:
            for g, n in features(t)[1].items():
                out[zlib.crc32(g.encode()) % buckets] += n
        return out

    s, t = spread(x for _, x in docs), spread(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for doc, text in docs:
        n, grams = features(text)
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] * k for g, k in grams.items())
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, sum(grams.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least))
    drawn = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))[: percent * sum(r[4] for r in rows) // 100]
    out = Counter((*r[:4], None) for r in rows)
    out.subtract((*r[:4], None) for r in drawn)
    return +out + Counter((*r[:4], i) for i, r in enumerate(drawn, 1))


def corpus(seed, n):
    r = random.Random(seed)
    vocabulary = ["the", "The", "Ünï", "ÀB", "x1", "中文", "", "a" * 70, "b" * 300, "no-one", "z\x00y", "\n"]
    return [(i, " ".join(r.choice(vocabulary) for _ in range(int(r.expovariate(1 / 40))))) for i in range(n)]


@pytest.mark.parametrize("texts", [["one two three", "", None, "a", "b c", "Dé É" + "x" * 65 + " y", "q" * 1000 + " r " + "s" * 64]])
def test_hashes_of_runs_are_crcs(texts):
    found = plain_words(pa.array(texts))
    each = [found.buf[a:b].tobytes() for a, b in zip(found.starts, found.ends)]
    for width, hashes in enumerate(run_hashes(found, 3), 1):
        assert hashes.tolist() == [zlib.crc32(b" ".join(each[i : i + width])) for i in range(len(each) - width + 1)]


@pytest.mark.parametrize("percent,pivots,few", [(5, 32, 4096), (50, 2, 3), (100, 1, 1), (1, 4, 10)])
def test_matches_brute_force(spark, percent, pivots, few):
    docs = corpus(percent, 300) + [(1000, None), (1001, ""), (1002, "--"), (None, "the " * 25), (None, "the " * 25), (7, "the x1 " * 30), (7, "the x1 " * 30)]
    target = [t for _, t in corpus(99, 20)] + [None]
    frame = spark.createDataFrame([(*d, 0, "x") for d in docs], "doc_id long, text string, weight int, row string").repartition(3)
    got = resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), percent=percent, pivots=pivots, few=few)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == brute(docs, target, percent)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample(none, none).count() == 0
    assert bucket_counts(none).count() == 0
    docs = corpus(3, 60)
    got = resample(spark.createDataFrame(docs, "doc_id long, text string"), none).collect()
    assert Counter(tuple(r) for r in got) == brute(docs, [])


@pytest.mark.parametrize("k", [1, 2, 499, 500, 730, 1000])
def test_quickselect(spark, k):
    rows = spark.range(1000).selectExpr("id % 5 as below", "id % 7 = 0 as nameless", "id % 3 as id", "id as row").repartition(4)
    want = sorted(tuple(r) for r in rows.collect())
    assert kth_key(rows, k, 1000, pivots=3, few=5) == want[k - 1]


def test_a_very_long_text(spark):
    text = "Word " * 300_000 + "y" * 2_000_000
    got = resample(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([("word",)], "text string"), percent=100).collect()
    assert (got[0].n_features, got[0]["rank"]) == (3 * 300_001 - 3, 1)
    assert Counter(tuple(r) for r in got) == brute([(1, text)], ["word"], 100)
    assert importance.WIDEST == 3
