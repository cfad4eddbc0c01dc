import random

import pytest
from tokenizers import Tokenizer

from tidewright.llm import bpe

PATH = f"{bpe.TOKENIZERS}/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def theirs():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def ours(texts):
    e = bpe.Encoder(PATH)
    return [bpe.unpacked(x).tolist() for _, some in bpe.batches_of(texts) for x in e.encode(some)]


ODD = [None, "", " ", "\n", "a", "<|endoftext|>", "don't I'LL we've 's'd", "a" * 5000, " " * 3000 + "x", "\n\n \t x", "a\x1cb \x1c c", "　a　　b", "\x85 \x85x", "é" * 900, "中文" * 1200, "\r\n\r\n x", "x \xa0 y", "\x0b\x0c a", "0123456789" * 300, "👩‍🔧" * 80, "=" * 513, "=" * 512, "=-" * 700, "﻿abc", "été"]


def test_odd_texts(theirs):
    assert ours(ODD) == theirs(ODD)


def test_random_texts(theirs):
    r = random.Random(7)
    texts = ["".join(r.choice("abcde ABC019.,;(){}\n\t'stéß中ю　\x1c\x85<|>_-=") for _ in range(r.randint(0, 80))) for _ in range(3000)]
    assert ours(texts) == theirs(texts)


def test_long_and_batched_merges_agree():
    m, r = bpe.Merges(PATH), random.Random(3)
    for n in (2, 3, 8, 31, 64, 200):
        words = [bytes(r.choice(b"abcdefgh  \xc3\xa9the") for _ in range(r.randint(2, n))) for _ in range(40)]
        size = 1 << (max(map(len, words)) - 1).bit_length()
        assert bpe.merge_many(words, size, m) == [bpe.merge_long(w, m) for w in words]


def test_caches_that_overflow_change_nothing(theirs, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 50)
    monkeypatch.setattr(bpe, "BATCH", 40)
    texts = [f"word{i} and word{i % 7}\n  next line {i}" for i in range(100)]
    assert ours(texts) == theirs(texts)


def test_operator(spark, theirs):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate([*ODD, "twice", "twice"])], "doc_id long, text string, ids string, key int")
    got = {r.doc_id: r.ids for r in bpe.encode_column(df, "doc_id", "text").collect()}
    assert [got[i] for i in range(len(ODD) + 2)] == theirs([*ODD, "twice", "twice"])
    assert bpe.encode_column(df.limit(0), "doc_id", "text").collect() == []
