import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lakeops.llm import packing
from lakeops.llm.packing import Encoder, best_fit_decreasing, pack_documents, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


TEXTS = [
    "Don't you're 'tis we'll I'd I'm they've rock'n'roll ''s '' '\"s 's's'S'RE l'l 'v 'r",
    "Ünï ÀÉÎ ß×÷ ÿŸ Ǆǅǆ İstanbul ΣΟΦΟΣ é café ﬁ ½ ²3 ٣٤",
    "中文字符 日本語 русский текст עברית",
    "a b c\u0085d\x00e\x01f\x7f",
    "<|endoftext|> <|startoftext|>x <|",
    "x" * 70 + " " + "?!" * 50 + " " + "é" * 40,
    "1234 12a3 a1'b2 $$$### _under_score_",
    "",
    None,
    " \t\n ",
    "\U0001f600\U0001f600 👨‍👩‍👧 naïve퟿",
]


@pytest.mark.parametrize("together", [3, 50_000])
def test_ids_are_the_librarys(library, together, monkeypatch):
    monkeypatch.setattr(packing, "_TOGETHER", together)
    r = random.Random(5)
    signs = "abcdé'ßÀ×1 2.,'strevmld\ńİσΣ中"
    texts = TEXTS + ["".join(r.choice(signs) for _ in range(r.randrange(200))) for _ in range(400)]
    encoder = Encoder(PATH)
    assert encoder.by_runs
    flat, counts = encoder.encode(pa.array(texts))
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends, strict=True):
        assert flat[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_runs_with_equal_hashes_stay_apart(library, monkeypatch):
    monkeypatch.setattr(np, "unique", lambda x, unique=np.unique, **k: unique(x & np.uint64(1) if x.dtype == np.uint64 else x, **k))
    texts = ["one two three", "two onetwo ones"]
    flat, _ = Encoder(PATH).encode(pa.array(texts))
    assert flat.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]


def one_by_one(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits)[1]] -= length
        else:
            rooms.append(capacity - length)
    return rooms


@pytest.mark.parametrize("seed", range(40))
def test_the_plan_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([1, 7, 16, 50, 100])
    lengths = [min(capacity, max(1, int(r.expovariate(r.choice([1, 3, 10]) / capacity)))) for _ in range(r.randrange(300))]
    counts = Counter(lengths)
    moves = best_fit_decreasing(counts, capacity)
    taken, ends = defaultdict(list), defaultdict(int)
    for i, (length, piece, begin, each, offset) in enumerate(moves):
        end = moves[i + 1][1] if i + 1 < len(moves) and moves[i + 1][0] == length else counts[length]
        assert ends[length] == piece
        ends[length] = end
        for k in range(end - piece):
            taken[begin + k // each].append((offset + k % each * length, length))
    assert dict(ends) == dict(counts)
    assert sorted(taken) == list(range(len(taken)))
    for places in taken.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in taken.values()) == sorted(one_by_one(lengths, capacity))


def test_lengths_beyond_the_capacity_are_errors():
    with pytest.raises(ValueError):
        best_fit_decreasing({5: 1}, 4)


def test_pieces_of_documents(spark, library):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["one", "deux", "drei3", "cuatro!"]) for _ in range(int(r.expovariate(1 / 30))))) for i in range(300)]
    rows += [(7, rows[7][1])] * 40 + [(None, "null id")] * 30 + [(900, None), (901, ""), (902, "word " * 700)]
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id long, text string, task string, number int").repartition(5)
    got = [x.asDict() for x in pack_documents(docs, PATH, capacity=64, ids=True).collect()]
    want = Counter()
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for n, a in enumerate(range(0, len(ids), 64)):
            want[doc, n, a, len(ids[a : a + 64]), zlib.crc32(np.array(ids[a : a + 64], "<u4").tobytes()), tuple(ids[a : a + 64])] += 1
    assert Counter((g["doc_id"], g["piece"], g["start"], g["length"], g["ids_crc32"], tuple(g["ids"])) for g in got) == want
    by = defaultdict(list)
    for g in got:
        by[g["sequence_id"]].append((g["offset"], g["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) == len(one_by_one([g["length"] for g in got], 64))
    whole = {s["sequence_id"]: s for s in sequences(spark.createDataFrame([(g["doc_id"], g["length"], g["ids"], g["sequence_id"], g["offset"]) for g in got], "doc_id long, length long, ids array<int>, sequence_id long, offset long")).collect()}
    assert all(len(s["ids"]) == s["n_tokens"] <= 64 for s in whole.values()) and sum(len(s["doc_ids"]) for s in whole.values()) == len(got)


def test_empty_tables_and_a_very_long_text(spark, library):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
    text = "länger " * 400_000 + "x" * 300_000
    got = pack_documents(spark.createDataFrame([("a", text)], "doc_id string, text string"), PATH).orderBy("piece").collect()
    n = len(library.encode(text, add_special_tokens=False).ids) + 1
    assert sum(g.length for g in got) == n and len(got) == -(-n // 4096) and len({g.sequence_id for g in got}) == len(got)
