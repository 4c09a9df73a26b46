import os
import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from loquela.llm import byte_bpe as B

pytestmark = pytest.mark.skipif(not os.path.exists(B.VOCABULARY), reason="no vocabulary here")


@pytest.fixture(scope="module")
def pair():
    with open(B.VOCABULARY, "rb") as f:
        ranks = B.read_ranks(f.read())
    return B.Encoder(ranks), tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_as_library(pair):
    mine, theirs = pair
    rng = random.Random(0)
    texts = ["", " ", "\n\n  x", "<|endoftext|>", "Perché l'università è così? 🙂👍🏽\r\n", "a" * 3000, "é" * 500, "\0​﻿"]
    texts += ["".join(rng.choice(alphabet) for _ in range(n)) for alphabet in ("ab", "abcdefghijklm", "è€😀 x", "0123 .,") for n in (5, 95, 96, 97, 400)]
    for t in texts:
        assert mine.encode(t) == theirs.encode_ordinary(t)
    assert mine.encode(None) == []


def test_both_merges_agree(pair):
    ranks, rng = pair[0].ranks, random.Random(1)
    for _ in range(300):
        piece = bytes(rng.choice(b"abcde \xc3\xa8") for _ in range(rng.randrange(2, 60)))
        assert B.merge_short(piece, ranks) == B.merge_long(piece, ranks)


def test_rows(spark, pair):
    rows = [(1, "ciao"), (2, None), (3, ""), (4, "ciao"), (4, "ciao"), (5, "lungo " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x")).withColumn("_text", F.lit(1))
    got = B.encode(df, ["doc_id"]).collect()
    assert sorted((r["doc_id"], len(r["ids"])) for r in got) == sorted((i, len(pair[1].encode_ordinary(t or ""))) for i, t in rows)
    assert B.encode(df.limit(0), ["doc_id"]).count() == 0
