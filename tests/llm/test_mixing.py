import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from loquela.llm import byte_bpe, mixing


def test_permutation():
    for n in (1, 2, 3, 10, 1000, 1025):
        assert sorted(mixing.permute(np.arange(n), n, 5).tolist()) == list(range(n))
    assert mixing.permute(np.arange(1000), 1000, 5).tolist() != mixing.permute(np.arange(1000), 1000, 6).tolist()


def test_quotas():
    shares = np.array([0.5, 0.3, 0.2, 0.0])
    assert mixing.quotas(shares, np.array([1000, 1000, 1000, 10]), 100).tolist() == [50, 30, 20, 0]
    assert mixing.quotas(shares, np.array([1000, 1000, 2, 10]), 100).sum() == 100
    assert mixing.quotas(shares, np.array([5, 5, 5, 5]), 100).tolist() == [5, 5, 5, 0]
    assert mixing.quotas(shares, np.zeros(4, np.int64), 100).tolist() == [0, 0, 0, 0]


def test_shards_add_up():
    quota = np.array([500, 1300, 7, 0])
    parts = [mixing.shard_counts(quota, s, 100, 3) for s in range(19)]
    assert np.sum(parts, axis=0).tolist() == quota.tolist()
    assert [int(c.sum()) for c in parts] == [100] * 18 + [7]
    drawn = [set(zip(*(x.tolist() for x in mixing.shard_tickets(quota, s, 100, 3)))) for s in range(19)]
    assert set().union(*drawn) == {(i, k) for i, q in enumerate(quota) for k in range(q)}  # each use of each ticket once


@pytest.mark.parametrize("scale", [1, 10**3, 10**9])
def test_the_same_law_at_any_size(scale):
    quota = np.array([300, 600, 100]) * 10 * scale
    shards = int(quota.sum()) // 1000
    counts = np.array([mixing.shard_counts(quota, s, 1000, seed) for seed in range(20) for s in np.linspace(0, shards - 1, 3).astype(int)])
    assert np.abs(counts.mean(0) - [300, 600, 100]).max() < 12
    spread = np.sqrt(np.array([0.3, 0.6, 0.1]) * np.array([0.7, 0.4, 0.9]) * 1000 * (1 - 1000 / int(quota.sum())))
    assert (np.abs(counts.std(0) / spread - 1) < 0.45).all()


@pytest.mark.skipif(not os.path.exists(byte_bpe.VOCABULARY), reason="no vocabulary here")
def test_mixture(spark):
    rows = [(i, "a" if i < 80 else "b", f"testo numero {i} " * (1 + i % 7)) for i in range(100)] + [(200, "a", None), (201, "b", ""), (202, None, "x"), (203, "z", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("n", F.lit("x")).withColumn("ids", F.lit("x"))
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("none", 0.2, 3)], "source string, target_share double, max_repeat int")
    mix = mixing.mix(docs, targets, block_tokens=16, shard_slots=8, with_ids=True)
    used = mix.select("source", "use_no", F.explode("pieces").alias("p")).groupBy("source", "p.doc_id", "p.from").count().groupBy("source").agg(F.max("count").alias("m")).collect()
    assert all(r["m"] <= {"a": 1, "b": 3}[r["source"]] for r in used)
    whole = {r["doc_id"]: r["ids"] for r in byte_bpe.encode(docs, ["doc_id"]).collect()}
    for r in mix.limit(50).collect():
        assert sum(len(p["ids"]) for p in r["pieces"]) == r["n_tokens"] <= 16
        assert all(list(p["ids"]) == whole[p["doc_id"]][p["from"] : p["to"]] for p in r["pieces"])
    got = {r["source"]: r for r in mixing.shares(mix, targets).collect()}
    assert got["none"]["actual_share"] == 0 and abs(sum(r["actual_share"] for r in got.values()) - 1) < 1e-9
    assert mixing.mix(docs.limit(0), targets).count() == 0
