import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from lakeops.llm import quality
from lakeops.llm.quality import keep_good, quality_verdicts

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    times = Counter(grams)
    hit = {j for i, g in enumerate(grams) if times[g] > 1 for j in range(i, i + 5)}
    seen, copied = set(), 0
    for line in text.split("\n"):
        copied += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), copied, len(hit)


def brute(rows):
    """doc_id to verdict: the same estimator over numpy arrays."""
    s = [base(t) for _, t, _, _ in rows]
    failed = [n < 10 or 100 * r > 20 * n for n, _, _, _, r in s]
    x = np.array([[round(v * quality.UNIT) for v in (math.log(max(n, 1)), math.log(max(c, 1) / max(n, 1)), math.log1p(100 * y / max(c, 1)), math.log1p(d), math.log1p(100 * r / max(n, 1)))] for n, c, y, d, r in s], float)
    sizes = Counter((lang, src) for (_, _, lang, src), f in zip(rows, failed) if not f)
    langs = Counter(lang for (_, _, lang, _), f in zip(rows, failed) if not f)
    group = [(lang, src) if sizes[lang, src] >= 50 else lang if (lang, src) in sizes and langs[lang] >= 50 else "all" for _, _, lang, src in rows]
    members = defaultdict(list)
    for i, g in enumerate(group):
        if not failed[i]:
            members[g].append(i)
    best = {}
    floor = np.array(quality.FLOORS) * quality.UNIT
    def estimate(z, share):
        mean = z.mean(0)
        cov = (z.T @ z / len(z) - np.outer(mean, mean)) * quality.consistency(share) + np.diag(floor**2)
        return mean, np.linalg.inv(cov), np.linalg.slogdet(cov)[1]

    def distances(y, mean, precision):
        return np.einsum("ij,jk,ik->i", y - mean, precision, y - mean)

    state = {}
    for g, m in members.items():
        centre = np.median(x[m], axis=0)
        mad = np.median(abs(x[m] - centre), axis=0)
        for start, sd in enumerate((np.maximum(1.4826 * mad, floor), floor)):
            state[g, start] = (centre, np.diag(1 / sd**2), math.inf)
    for step in itertools.count():
        falls = False
        for (g, start), (mean, precision, was) in state.items():
            y = x[members[g]]
            bins = np.floor(32 * np.log2(distances(y, mean, precision) + 0.01)).astype(int)
            state[g, start] = estimate(y[bins <= np.sort(bins)[(len(bins) - 1) // 2]], 0.5)
            falls |= state[g, start][2] < was - quality.TOLERANCE
        if step and not falls:
            break
    for g in members:
        _, (mean, precision, _) = min((state[g, s][2], s) + (state[g, s],) for s in (0, 1))[1:]
        y = x[members[g]]
        best[g] = estimate(y[distances(y, mean, precision) <= quality.NEAR], quality.TRUSTED)[:2]
    out = {}
    for i, (doc, *_) in enumerate(rows):
        d = None
        if group[i] in best:
            mean, precision = best[group[i]]
            d = float((x[i] - mean) @ precision @ (x[i] - mean))
        out[doc] = (*s[i][:1], *s[i][1:], failed[i], not failed[i] and (d is None or d <= quality.CUTOFF), d)
    return out


def test_chi_square():
    # table values
    assert abs(quality.chi2_quantile(0.5, 5) - 4.3515) < 1e-3 and abs(quality.chi2_quantile(0.999, 5) - 20.515) < 1e-3 and abs(quality.chi2_quantile(0.95, 2) - 5.9915) < 1e-3
    r = np.random.default_rng(2).normal(size=(200_000, 5))
    d = (r**2).sum(1)
    assert abs(r[d <= np.median(d)].var(0).mean() * quality.consistency(0.5) - 1) < 0.02


def corpus():
    r = random.Random(3)
    rows = []
    for i in range(420):
        w = ["".join(r.choice("abcdeéß") for _ in range(r.randrange(2, 9))) for _ in range(int(math.exp(r.gauss(4, 0.8))))]
        if i % 11 == 0:
            w = [x + r.choice(["###", "&&", "|"]) for x in w]
        if i % 17 == 0:
            w += w[:7] * r.randrange(1, 4)
        lines = [" ".join(w[k : k + 9]) for k in range(0, len(w), 9)]
        if i % 13 == 0:
            lines += lines[:2]
        rows.append((i, "\n".join(lines), r.choice(["en", "de", None]), r.choice(["a", "a", "a", "b", None])))
    rows += [(900, None, "en", "a"), (901, "", "xx", None), (902, " \t\n", "en", "a"), (903, "x " * 5000, "en", "a"), (904, "a b c d e\x85f g h i j k l", "en", "zz"), (905, "\n\n \na\na\n", "en", "a")]
    return rows


def test_statistics_and_verdicts_match_brute_force(spark):
    rows = corpus()
    want = brute(rows)
    got = quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(got) == len(rows)
    for r in got:
        *stats, failed, kept, d = want[r.doc_id]
        assert [r[c] for c in quality.STATISTICS] == stats and r.base_failed == failed and r.kept == kept, (r, want[r.doc_id])
        assert (d is None) == (r.distance is None) and (d is None or abs(d - r.distance) < 1e-6 * max(1, d))
    assert 0 < sum(not r.kept and not r.base_failed for r in got) < 80


def test_keep_good_keeps_rows_unchanged(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*x, 7) for x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    good = {i for i, v in brute(rows).items() if v[6]}
    assert sorted(map(tuple, keep_good(docs).collect())) == sorted((*x, 7) for x in rows if x[0] in good)


def test_keep_good_with_any_column_names(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*x, 7, True, "g", [x[0]]) for x in rows], "doc_id long, text string, lang string, source string, n_words long, kept boolean, grp string, `odd name, x` array<long>")
    good = {i for i, v in brute(rows).items() if v[6]}
    got = keep_good(docs)
    assert got.schema == docs.schema
    assert sorted(map(tuple, got.collect())) == sorted((*x, 7, True, "g", [x[0]]) for x in rows if x[0] in good)


def test_empty_table_and_all_failed(spark):
    schema = "doc_id long, text string, lang string, source string, n_words string, kept int"
    assert quality_verdicts(spark.createDataFrame([], schema)).count() == 0
    got = quality_verdicts(spark.createDataFrame([(1, "a", None, None, "x", 1), (1, "a", None, None, "x", 1)], schema)).collect()
    assert [(r.doc_id, r.n_words, r.kept, r.distance) for r in got] == [(1, 1, False, None)] * 2
