import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from lakeops.llm.bpe import Merges, _encode_long, decode_documents, encode_documents, encode_word, load_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})


def texts():
    r = random.Random(4)
    out = [None, "", " ", "\n\n \t", "<|endoftext|> it's I'LL don't", "a" * 5000, "ab" * 3000, "日本語テキスト" * 50, "مرحبا بالعالم 123 ٣٤", "👩‍👩‍👧‍👦 é   x\x85\x1c", "0" * 777, "\x00\x01"]
    for _ in range(60):
        out.append("".join(r.choice(["a", "b1", "'s", "x.", "é", " ", " ", " ", "  ", "\n", "\n ", " \n", "\t", "\x1c", "\x85", "\u00a0", "\u2003", "!"]) for _ in range(r.randrange(200))))
    for _ in range(60):
        out.append("".join(r.choice("abcdeéßñ日🙂 \n\t'0129.,!|# ") for _ in range(r.randrange(400))))
    return out + out[4:9]


def test_ids_and_decoded_bytes_equal_the_reference(spark, reference):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in encode_documents(docs, PATH, public_tokenizers.PATTERN, ids=True).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids), t
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = decode_documents(spark.createDataFrame([(i, r.ids) for i, r in got.items()], "doc_id long, ids array<int>"), PATH)
    assert {r.doc_id: bytes(r.bytes).decode() for r in back.collect()} == {i: t or "" for i, t in rows}


def test_shuffled_documents_and_decoding(spark, reference):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    got = {r.doc_id: r.ids for r in encode_documents(docs, PATH, public_tokenizers.PATTERN, ids=True, buckets=3, stable=False).collect()}
    assert got == {i: reference.encode_ordinary(t or "") for i, t in rows}
    with pytest.raises(Exception, match="token-byte table"):
        decode_documents(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>"), PATH).collect()
    assert [r.bytes for r in decode_documents(spark.createDataFrame([(1, None), (1, [])], "doc_id long, ids array<int>"), PATH).collect()] == [b"", b""]


def test_long_words_merge_like_short_ones(reference):
    ranks = load_ranks(PATH)
    r = random.Random(9)
    words = ["".join(r.choice("abeinrst") for _ in range(r.randrange(1, 80))).encode() for _ in range(500)] + [b"a" * n for n in range(1, 70)] + ["éß日".encode()]
    together = [x.tolist() for x in Merges(ranks).encode(words)]
    for w, ids in zip(words, together):
        assert ids == reference._encode_single_piece(w) == encode_word(w, ranks) and (w in ranks or _encode_long(w, ranks) == ids)
    assert Merges(ranks).encode([]) == []


def test_empty_table_repeated_rows_and_extra_columns(spark):
    assert encode_documents(spark.createDataFrame([], "doc_id long, text string"), PATH, public_tokenizers.PATTERN).count() == 0
    docs = spark.createDataFrame([(1, "x y", 1), (1, "x y", 1), (None, "z", 2)], "doc_id long, text string, slice int")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in encode_documents(docs, PATH, public_tokenizers.PATTERN).collect()) == [(0, 1), (1, 2), (1, 2)]
