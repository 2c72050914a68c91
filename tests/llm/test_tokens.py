import os

import pytest
import tiktoken
from pyspark.sql import functions as F

from quillspark.llm import tokens as T

pytestmark = pytest.mark.skipif(not os.path.exists(os.path.join(T.FOLDER, T.VOCABULARY)), reason="no vocabulary here")
TEXTS = ["", None, "Hello, world!  Two\n\n\tlines ", "<|endoftext|> is text", "ærø ØRE’s it's I'll we've", "²½ Ⅷ 一二 x_y __ a\x1cb", "　wide space ", "🙂‍🙂 ē", "1234567890" * 50, "a" * 20_000, "abc" * 4000, " \n \n", "'" * 7, "ab 'S 'LL"]


def reference(vocabulary=T.VOCABULARY):
    import public_tokenizers as P

    ranks = {b: i for i, b in enumerate(T.read_vocabulary(os.path.join(T.FOLDER, vocabulary)))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_the_library_and_goes_back(spark):
    enc = reference()
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(2, TEXTS[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(0), "key": F.lit("clash")})
    got = T.encode_corpus(df).collect()
    assert len(got) == len(rows)
    for r in got:
        text = TEXTS[r["doc_id"]]
        assert r["ids"] == enc.encode_ordinary(text or "") and enc.decode(r["ids"]) == (text or "")
    assert T.encode_corpus(df.limit(0)).count() == 0


def test_documents(spark, folder):
    enc = reference()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: r["ids"] for r in T.encode_corpus(docs).collect()}
    assert got == {r["doc_id"]: enc.encode_ordinary(r["text"] or "") for r in docs.collect()}


def test_another_vocabulary(spark):
    df = spark.createDataFrame([(1, "Blåbærgrød på øen")], "doc_id long, text string")
    assert T.encode_corpus(df, vocabulary="byte_bpe_multi_50k.tiktoken").first()["ids"] == reference("byte_bpe_multi_50k.tiktoken").encode_ordinary("Blåbærgrød på øen")


def test_hash_is_perfect_and_minimal():
    keys = [f"k{i}".encode() for i in range(5000)]
    table = T.PerfectHash(keys)
    assert table.find(keys) == list(range(5000)) and set(table.find([b"x", b"k5000", b""])) == {-1}
    assert sorted(table.keys) == sorted(keys)


def test_merges_take_the_lowest_rank_then_the_leftmost():
    ranks = {bytes([c]): c for c in range(256)} | {b"ab": 300, b"bc": 299, b"bcd": 304, b"abc": 301, b"aa": 302, b"aaa": 303}
    assert T.merge(b"abc", ranks) == (301,) and T.merge(b"aaaa", ranks) == (302, 302) and T.merge(b"aaa", ranks) == (303,) and T.merge(b"x", ranks) == (120,) and T.merge(b"abd", ranks) == (300, 100)
