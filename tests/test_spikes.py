import numpy as np
import pytest
from pyspark.sql import functions as F

from loquela.operators import spikes

SEG = "segment_id long, stem string, idx int, speaker string, text string, start_sec double, f0_mean_hz double, jitter_local double, shimmer_local double, voice string"


def segments():
    rng = np.random.default_rng(0)
    rows = [(i, f"s{i // 50}", i % 50, "GLOBAL_00000007", "ciao", float(i % 50), 120 + 8 * rng.standard_normal(), 0.02 * np.exp(0.1 * rng.standard_normal()), 0.08 * np.exp(0.1 * rng.standard_normal()), "x") for i in range(200)]
    rows = [list(map(lambda x: float(x) if isinstance(x, np.floating) else x, r)) for r in rows]
    rows[5][6] = 9999.0
    rows[6][6] = -1.0
    rows[60][6] = 240.0
    rows[70][7] = 1.73
    for i in (100, 101, 103, 104, 105):
        rows[i][8] = 0.07
    rows[102][8] = None
    for i in (110, 111, 112, 113):
        rows[i][8] = 0.071
    rows.append([900, "s2", 105 % 50, *rows[105][3:]])
    rows.append([901, "s9", 1, None, None, 1.0, 9999.0, 0.02, None, "x"])
    rows.append([902, "s9", 2, "GLOBAL_00000007", "", None, 20000.0, float("nan"), None, "x"])
    return [tuple(r) for r in rows]


def test_segments(spark):
    df = spark.createDataFrame(segments(), SEG)
    smap = spark.createDataFrame([("s0", "SPEAKER_00", "GLOBAL_00000007")], "stem string, local_label string, global_id string")
    got = {(r["row_id"], r["field"]) for r in spikes.segment_cases(df, smap).collect()}
    stuck = {(i, "shimmer_local") for i in (100, 101, 103, 104, 105, 900)}
    assert got == {(5, "f0_mean_hz"), (6, "f0_mean_hz"), (60, "f0_mean_hz"), (70, "jitter_local"), (902, "f0_mean_hz"), (902, "jitter_local")} | stuck
    assert spikes.segment_cases(df.limit(0), smap.limit(0)).count() == 0


@pytest.mark.parametrize("context", [spikes.CONTEXT])
def test_readings(spark, context):
    rng = np.random.default_rng(1)
    rows, bpm = [], 70.0
    for i in range(600):
        bpm = 70 + 45 * max(0, np.sin(i / 40)) + rng.integers(-2, 3)
        rows.append([i, 3, f"2025-05-{1 + i // 400:02d}", f"{i % 400 // 60:02d}:{i % 60 if i < 400 else (i - 400) % 60:02d}", int(bpm), 1])
    for i in range(600):
        m = i % 400
        rows[i][2], rows[i][3] = f"2025-05-{1 + i // 400:02d}", f"{m // 60:02d}:{m % 60:02d}"
    rows[50][4], rows[51][4], rows[200][4], rows[300][4] = 255, -1, rows[199][4] + 60, None
    for i in range(420, 436):
        rows[i][4] = 88
    rows.append([1000, 3, *rows[430][2:5], 2])
    rows.append([1001, 3, None, "10:00", 300, 2])
    rows.append([1002, None, "2025-05-01", "10:00", 300, 2])
    df = spark.createDataFrame([tuple(r) for r in rows], "reading_id long, wearer_id long, hr_date string, hr_time string, heart_rate int, export_ms long").withColumn("value", F.lit(0))
    got = {r["row_id"] for r in spikes.reading_cases(df.repartition(5)).collect()}
    assert got == {50, 51, 200, 1000, 1001} | set(range(420, 436))
    assert spikes.reading_cases(df.limit(0)).count() == 0


def test_forest_isolates():
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.standard_normal((500, 3)), np.zeros(500)])
    x[7, :3], x[8, :3] = 30, -5.7
    probes = np.array([[s * spikes.FAR] * 3 + [0.0] for s in (1, -1)])
    score, odd = spikes.isolated(x, x[:200], probes, spikes.VOICE_FEATURES)
    assert score.argmax() == 7 and np.flatnonzero(odd).tolist() == [7, 8]
    assert np.flatnonzero(spikes.isolated(x, x[:0], probes, spikes.VOICE_FEATURES)[1]).tolist() == [7, 8]


def test_the_forest_decides(spark):
    df, smap = spark.createDataFrame(segments(), SEG), spark.createDataFrame([], "stem string, local_label string, global_id string")
    at = lambda i: ("2025-05-01", f"{i // 60:02d}:{i % 60:02d}")
    pulse = [(i, 3, *at(i), {200: 120, 400: 35}.get(i, 70 + i % 3), 1) for i in range(600)]
    beats = spark.createDataFrame(pulse, "reading_id long, wearer_id long, hr_date string, hr_time string, heart_rate int, export_ms long")
    for rows, far, some in ((lambda d: spikes.segment_cases(df, smap, *d), {60}, 5), (lambda d: spikes.reading_cases(beats, *d), {200, 400}, 5)):
        found = lambda *d: {r["row_id"] for r in rows(d).collect()}  # noqa: E731, B023
        want = found()
        assert far <= want
        for verdict in (True, False):
            got = found(lambda x, *a: (np.zeros(len(x)), np.full(len(x), verdict)))  # noqa: B023
            assert (len(got) > some * len(want)) if verdict else not got & far, (verdict, len(got), len(want), got & far)


@pytest.mark.parametrize("parts", [1, 7, 50])
def test_partitions_and_repeats_do_not_matter(spark, parts):
    at = lambda i: ("2025-05-01", f"{i // 60:02d}:{i % 60:02d}")
    value = {200: 120, 900: 30, **dict.fromkeys(range(300, 316), 88), **dict.fromkeys(range(500, 506), 150)}
    rows = [(10_000 * k + i, 3, *at(i), value.get(i, 70 + i % 3), k) for i in range(1200) for k in range(10)]
    df = spark.createDataFrame(rows, "reading_id long, wearer_id long, hr_date string, hr_time string, heart_rate int, export_ms long")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r["row_id"] for r in spikes.reading_cases(df.repartition(parts)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == {10_000 * k + i for i in value for k in range(10)}


def test_runs_and_bursts_across_slices(spark):
    start = 30 * 678  # a day on which a slice begins (days since 1970)
    when = lambda m: str(np.datetime64("1970-01-01") + np.timedelta64(start * 1440 + m, "m")).split("T")
    value = {**dict.fromkeys(range(-8, 9), 88), -30: 140, -1440 * 30: 71, 30: 140, 29: 141}
    minutes = sorted({*range(-120, 121), *range(-1440 * 30 - 3, -1440 * 30 + 3)})
    rows = [(n, 3, *when(m), value.get(m, 70 + m % 3), 1) for n, m in enumerate(minutes)]
    df = spark.createDataFrame(rows, "reading_id long, wearer_id long, hr_date string, hr_time string, heart_rate int, export_ms long")
    got = {minutes[r["row_id"]] for r in spikes.reading_cases(df).collect()}
    assert got == {*range(-8, 9), -30, 29, 30}


def test_bursts():
    t, v = np.arange(12.0), np.array([70, 71, 140, 70, 71, 141, 139, 138, 142, 140, 71, 70.0])
    assert (np.abs(spikes.burst_amplitude(t, v, np.full(12, 70.0))) > 60).tolist() == [c > 100 for c in v]
    slow = 70 + 60 * np.sin(np.arange(60) / 60 * np.pi)
    assert np.abs(spikes.burst_amplitude(np.arange(60.0), slow, np.full(60, 70.0))).max() < 5
    assert spikes.burst_amplitude(np.zeros(0), np.zeros(0), np.zeros(0)).tolist() == []


def test_runs():
    v, g = np.array([1, 1, 2, 2, 2, 2]), np.array([0, 0, 0, 0, 1, 1])
    assert spikes.run_lengths(v, g).tolist() == [2, 2, 2, 2, 2, 2]
    assert spikes.run_lengths(np.zeros(0), np.zeros(0)).tolist() == []


SEGMENT = "segment_id long, stem string, idx int, speaker string, text string, start_sec double, f0_mean_hz double, jitter_local double, shimmer_local double"


@pytest.mark.parametrize("copies", [5, 50, 200])
def test_copies_of_a_wrong_segment(spark, copies):
    rng = np.random.default_rng(4)
    rows = [(i, f"s{i // 50}", i % 50, "GLOBAL_00000007", "ciao", float(i % 50), float(120 * np.exp(0.1 * rng.standard_normal())), None, None) for i in range(100)]
    rows += [(1000 + i, "s9", 1, "GLOBAL_00000007", "ciao", 1.0, 400.0, None, None) for i in range(copies)]
    got = {r["row_id"] for r in spikes.segment_cases(spark.createDataFrame(rows, SEGMENT), spark.createDataFrame([], "stem string, local_label string, global_id string")).collect()}
    assert got == {1000 + i for i in range(copies)}


def test_equal_wrong_values_of_small_voices(spark):
    rng = np.random.default_rng(5)
    rows = [(100 * v + i, f"s{v}", i, f"GLOBAL_{v:08d}", "ciao", float(i), 400.0 if v < 20 and i in (2, 5, 8) else float(120 * np.exp(0.1 * rng.standard_normal())), None, None) for v in range(40) for i in range(10 if v < 20 else 40)]
    got = {r["row_id"] for r in spikes.segment_cases(spark.createDataFrame(rows, SEGMENT), spark.createDataFrame([], "stem string, local_label string, global_id string")).collect()}
    want = {100 * v + i for v in range(20) for i in (2, 5, 8)}
    assert len(got & want) >= 0.9 * len(want) and not got - want


def test_numerous_wrong_readings(spark):
    rows = [(i, 3, f"2025-05-{1 + i // 1440:02d}", f"{i % 1440 // 60:02d}:{i % 60:02d}", 140 if i % 8 == 2 else 70 + i % 3, 1) for i in range(1000)]
    df = spark.createDataFrame(rows, "reading_id long, wearer_id long, hr_date string, hr_time string, heart_rate int, export_ms long")
    assert {r["row_id"] for r in spikes.reading_cases(df).collect()} == {i for i in range(1000) if i % 8 == 2}


@pytest.mark.parametrize("copies", [1, 3000])
def test_copies_of_a_reading_beside_a_cut(spark, copies):
    at = lambda i: ("2025-05-01", f"{i // 60:02d}:{i % 60:02d}")
    value = {200: 95, **{i: 88 for i in range(300, 318)}}  # a spike of 25 beats, a stuck run
    rows = [(i, 3, *at(i), value.get(i, 70 + i % 3), 1) for i in range(600)]
    for k, i in enumerate((200, 309)):
        rows += [(10_000 * (k + 1) + n, 3, *at(i), value[i], 2) for n in range(copies)]
    df = spark.createDataFrame(rows, "reading_id long, wearer_id long, hr_date string, hr_time string, heart_rate int, export_ms long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keeps the cuts of the range partitions
    try:
        got = {r["row_id"] for r in spikes.reading_cases(df.repartition(4)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {200} | set(range(300, 318)) | {10_000 * k + n for k in (1, 2) for n in range(copies)}
