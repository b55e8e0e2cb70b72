import random
import re
import zlib
from collections import Counter, defaultdict

from lakeops.llm.language_id import PROFILE, fit, identify, language_predictions


def words_of(text):
    return re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in (text or "").lower()))


def grams(text):
    out = Counter()
    for w in words_of(text):
        w = f" {w} "
        out.update(w[i : i + n] for n in (1, 2, 3) for i in range(len(w) - n + 1) if w[i : i + n].strip() and (n < 3 or w[i + 1] != " "))
    return out


def ranked(counter):
    # a shorter n-gram comes before its continuations, a boundary before letters
    return [g for g, _ in sorted(counter.items(), key=lambda x: (-x[1], x[0]))][:PROFILE]


def brute(rows):
    total = defaultdict(Counter)
    for doc, text, lang in rows:
        if lang is not None and text is not None and zlib.crc32(str(doc).encode()) % 5:
            total[lang].update(grams(text))
    profiles = {k: {g: i for i, g in enumerate(ranked(v))} for k, v in total.items() if v}
    out = {}
    for doc, text, _ in rows:
        own = ranked(grams(text))
        d = {k: sum(abs(i - p[g]) if g in p else PROFILE for i, g in enumerate(own)) for k, p in profiles.items()}
        best = min(sorted(d, key=lambda k: k.encode()), key=lambda k: d[k], default=None)
        out[doc] = ("und", 0.0) if not own or best is None else (best, 1 - d[best] / (len(own) * PROFILE))
    return out


def corpus():
    r = random.Random(6)
    letters = {"en": "etaoinshr", "de": "enisratdüß", "el": "αβγδεζηθ", "zh": "中文字母表语言"}
    rows = [(i, " ".join("".join(r.choice(s) for _ in range(r.randrange(1, 8))) + r.choice(["", ".", ", 3"]) for _ in range(r.randrange(1, 60))), k) for i, (k, s) in enumerate(list(letters.items()) * 40)]
    return rows + [(900, None, "en"), (901, "", "de"), (902, "123 .,!", "en"), (903, "A", None), (904, "Ünter İstanbul ǅ", None), (905, "x" * 5000, None), (906, "\U00010400 b", None), (907, "en", "İx")]


def test_matches_brute_force_and_held_out_accuracy(spark):
    rows = corpus()
    got = language_predictions(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r.lang_pred == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 1e-9, (r, want[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    lang = {i: k for i, _, k in rows[:160]}
    out = [r for r in got if r.held_out and r.doc_id in lang]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) > 0.9 * len(out)


def test_empty_tables_repeated_rows_and_extra_columns(spark):
    schema = "doc_id long, text string, lang string, gram string, score int"
    assert language_predictions(spark.createDataFrame([], schema)).count() == 0
    got = language_predictions(spark.createDataFrame([(None, "abc", None, "", 1), (1, "abc", None, "", 1), (1, "abc", None, "", 1)], schema)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 3


def test_a_rare_language_is_learned_from_a_bounded_sample(spark):
    rows = [(i, "abc abd", "en") for i in range(3000)] + [(5000, "βγδ", "el"), (5001, "中", None)]
    learned = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 10)
    assert {r.lang for r in learned.select("lang").distinct().collect()} == {"en", "el"}


def test_blocks_of_languages_give_the_same(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    profiles = fit(docs).persist()
    whole = sorted(map(tuple, identify(docs, profiles).collect()))
    for block in (1, 2, 3):
        assert sorted(map(tuple, identify(docs, profiles, block=block).collect())) == whole


def test_the_sample_is_the_rows_with_the_smallest_hashes(spark):
    """Also where copies of one row stand at its end."""
    from pyspark.sql import functions as F

    rows = [(i, f"{'abc'[i % 3]}{chr(100 + i % 20)} x", "one" if i % 4 else "two") for i in range(80)] + [(5, "repeated zz", "one")] * 60 + [(6, "other yy", "two")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    placed = docs.withColumn("order", F.xxhash64("doc_id", "text")).collect()
    for sample in (1, 7, 30, 90, 1000):
        want = {}
        for lang in ("one", "two"):
            total = Counter()
            for r in sorted((r for r in placed if r.lang == lang), key=lambda r: r.order)[:sample]:
                total.update(grams(r.text))
            want |= {(lang, i): g for i, g in enumerate(ranked(total))}
        assert {(r.lang, r.place): r.gram for r in fit(docs, sample).collect()} == want, sample


def test_a_text_of_megabytes(spark):
    rows = [(1, "abc " * 1000, "en"), (2, "жзи " * 1000, "ru"), (3, "abd " * 700_000, None), (4, "ж" * 2_000_000, None)]
    got = {r.doc_id: r.lang_pred for r in language_predictions(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert (got[3], got[4]) == ("en", "ru")
