import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loquela.operators.intervals import IntervalMap, merge_intervals
from loquela.streaming.flows import running_periods


def brute(rows):
    out = set()
    for e in {r[0] for r in rows if r[0] is not None}:
        periods = []
        for a, b in sorted((a, b) for k, a, b in rows if k == e and b is not None and b > a):
            if periods and a <= periods[-1][1]:
                periods[-1][1] = max(periods[-1][1], b)
            else:
                periods.append([a, b])
        out |= {("period", e, a, b) for a, b in periods} | {("gap", e, p[1], q[0]) for p, q in zip(periods, periods[1:])}
    return out


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(-2, 12)), max_size=40))
def test_map_matches_brute_force(rows):
    m = IntervalMap()
    for a, d in rows:
        m.insert(a, a + d)
    want = brute([(1, a, a + d) for a, d in rows])
    assert {("period", 1, *p) for p in m.periods()} | {("gap", 1, *g) for g in m.gaps()} == want


def test_buckets_do_not_show(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3]), a := rng.randrange(5000), a + rng.choice([-5, 0, 3, 40, 900])) for _ in range(400)]
    rows += rows[:30] + [(None, 1, 5), (1, 7, None), (4, 10, 20), (4, 20, 30), (4, 31, 32)]
    df = spark.createDataFrame(rows, "entity long, from_us long, to_us long").withColumn("bucket", F.lit("x"))
    for width in (7, 100, 10**9):
        got = {tuple(r) for r in merge_intervals(df, width).select("kind", "entity", "from_us", "to_us").collect()}
        assert got == brute(rows)
    assert merge_intervals(df.limit(0)).count() == 0


def test_streaming_state(spark, tmp_path):
    schema = "entity long, from_us long, to_us long"
    for i, rows in enumerate([[(1, 0, 10), (1, 20, 30)], [(1, 10, 20), (2, 5, 6)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = running_periods(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
        q = q.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(str(tmp_path / "out"))).trigger(availableNow=True).start()
        q.awaitTermination()
        got = {r["entity"]: (r["periods"], r["gaps"], r["covered_us"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
        assert got == ({1: (2, 1, 20)} if i == 0 else {1: (1, 0, 30), 2: (1, 0, 1)})
