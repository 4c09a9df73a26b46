import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loquela.llm.nearest_time import PiecewiseIndex, match_sorted, nearest_in_time


@given(st.lists(st.integers(-1000, 1000), max_size=300), st.lists(st.integers(-1100, 1100), max_size=50), st.integers(1, 70))
def test_index_is_exact(keys, probes, piece):
    keys, probes = np.unique(np.array(keys, dtype=np.int64)), np.array(probes, dtype=np.int64)
    if len(keys):
        assert (PiecewiseIndex(keys, piece).lower_bound(probes) == np.searchsorted(keys, probes)).all()
    best = match_sorted(keys, np.arange(len(keys)), probes, 25)
    for p, b in zip(probes, best):
        near = [abs(int(k) - int(p)) for k in keys]
        assert (b == -1) == (not near or min(near) > 25)
        assert b == -1 or near[b] == min(near)


def test_against_brute_force(spark):
    rng = random.Random(1)
    left = [(rng.choice([1, 1, 1, 2]), rng.randrange(4000), i) for i in range(500)] + [(None, 5, 900), (1, None, 901), (3, 7, 902)]
    right = [(rng.choice([1, 1, 2]), rng.randrange(0, 4000, 7), i) for i in range(300)] + [(None, 5, 900), (1, None, 901), (1, 700, 5000), (1, 700, 4999)]
    schema = "entity long, at long, id long"
    a, b = spark.createDataFrame(left, schema).withColumn("slot", F.lit("x")), spark.createDataFrame(right, schema).withColumn("kind", F.lit("x"))
    want = set()
    for e, t, i in left:
        near = [(abs(u - t), j) for f, u, j in right if e is not None and t is not None and f == e and u is not None and abs(u - t) <= 20]
        if near:
            want.add((i, min(near)[1]))
    for width in (50, 333, 10**6):
        assert {tuple(r) for r in nearest_in_time(a, b, 20, width).collect()} == want
    assert nearest_in_time(a.limit(0), b, 20).count() == 0
    assert nearest_in_time(a, b.limit(0), 20).count() == 0
