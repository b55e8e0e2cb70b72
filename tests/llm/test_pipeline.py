import hashlib
import math
import random
from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline
from lakeops.llm.bpe import load_ranks
from lakeops.llm.mixing import mix
from tests.llm.test_mixing import brute as mixed
from tests.llm.test_near_dedup import brute as near
from tests.llm.test_quality import brute as judged
from tests.llm.test_substring_dedup import WORD


def cut(rows, window=50):
    first, out = {}, []
    found = [(doc, WORD.findall(text)) for doc, text in rows]
    for doc, w in found:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, doc), doc)
    for (doc, text), (_, w) in zip(rows, found):
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < doc for j in range(i, i + window)}
        out.append((doc, " ".join(x for j, x in enumerate(w) if j not in gone) if gone else text))
    return out


def corpus():
    r = random.Random(12)
    passage = [f"p{r.randrange(9999)}" for _ in range(90)]
    rows = []
    for i in range(300):
        w = ["".join(r.choice("abcdeéß") for _ in range(r.randrange(2, 9))) for _ in range(r.randrange(1, 160))]
        if i % 6 == 0:
            at, start = r.randrange(len(w) + 1), r.randrange(30)
            w[at:at] = passage[start : start + r.randrange(55, 61)]
        if i % 9 == 0:
            w = [x + "###" for x in w]
        if i % 5 == 0 and rows:
            w = rows[r.randrange(len(rows))][1].split(" ")
            w[r.randrange(len(w))] += r.choice(["", "x"])
        rows.append((i, " ".join(w) if i % 4 else "\n".join(w), r.choice(["en", "de"]), r.choice(["a", "a", "b", None])))
    return rows + [(400, None, "en", "a"), (401, "", None, None)]


def test_the_stages_are_the_five_and_keep_the_columns(spark, tmp_path):
    assert len(corpus_pipeline.STAGES) == 5
    rows = [(i, t, lang, src, len(t or "")) for i, t, lang, src in corpus()[:40]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))


def test_run_matches_brute_force(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame([(i, t, lang, src, len(t or "")) for i, t, lang, src in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    verdict = judged(rows)
    left = [x for x in rows if verdict[x[0]][6]]
    classes = near([(i, t) for i, t, _, _ in left])
    left = [x for x in left if classes[x[0]] == x[0]]
    texts = dict(cut([(i, t) for i, t, _, _ in left]))
    taken = {doc: (n, k) for doc, n, _, _, k in mixed([(i, texts[i], src) for i, _, _, src in left])}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = Counter()
    for i, _, _, _ in left:
        n, k = taken[i]
        ids = encoding.encode_ordinary(texts[i])
        if k:
            want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[i].encode()).hexdigest()] += math.ceil(k / n)
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == want and 30 < len(got) < len(left) <= len(rows)
    assert len(left) < len(rows) and any(texts[i] != t for i, t, _, _ in left) and max(want.values()) > 1


def test_mixing_keeps_rows_with_null_and_repeated_ids(spark, tmp_path):
    """Every row comes as often as the mix took that row, whatever its doc_id."""
    r = random.Random(5)
    rows = []
    for i in range(120):
        text = " ".join([f"w{i}", *("x" for _ in range(r.randrange(1, 60)))])
        rows.append((None if i % 10 == 0 else i // 4, text, r.choice(["en", None]), "a" if i % 6 else "b", len(text)))
    rows.append((None, None, None, "a", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    # a text names its row
    taken = {x.text: (x.size, x.taken) for x in mix(docs, carry=corpus_pipeline.COLUMNS).collect()}
    assert len(taken) == len(rows) and sorted(taken.values()) == sorted((x.size, x.taken) for x in mix(docs).collect())
    want = Counter()
    for row in rows:
        n, k = taken[row[1]]
        if k:
            want[row] = math.ceil(k / n)
    got = Counter(tuple(x) for x in corpus_pipeline.source_mixing(spark, docs, str(tmp_path)).collect())
    assert got == want
    copies = {}
    for row in rows:
        copies.setdefault(row[0], set()).add(want[row])
    assert any(x[0] is None for x in got) and any(len(c) > 1 for doc, c in copies.items() if doc is not None)
