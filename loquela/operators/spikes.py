"""Problem 5: implausible spikes, stuck values and impossible readings.

An isolation forest per source decides which values are far outside the source's normal behaviour. Its features are, in
units of the source's own spread:

- level: distance from the source's usual value;
- difference: distance from the neighbours in time (segments: from the median of five in the session; readings: how far a
  burst of readings leaves both its sides at once);
- season: distance from what is usual at that time (segments: the voice's median in that recording; readings: the
  wearer's median at that hour of the day);
- run: length of the run of equal values.

The forest is grown on a sample of the source's ordinary readings (`PSI`, first by hash; readings more than `ORDINARY`
units out take no part, and a source with fewer is filled up with draws of usual spread, so there is no least size).
Cuts reach beyond the sample, so paths grow shorter the farther a value lies outside. The threshold on the score is set
per source: the score that its forest gives to a probe, a value `FAR` out in level, difference and season (a reading:
`FAR_JUMP` beats off its sides). Every stored reading is scored, and the score alone decides; explicit rules add
physically impossible values and stuck runs.

Scale: segments are ordered within their session. Distinct pulse readings are judged by (wearer, `SLICE_DAYS` days), and
each slice gets the last and first `CONTEXT` readings and the open runs of the slices beside it from one summary row a
slice, so nothing goes to the driver and results do not depend on the partitioning. A wearer with a third of all rows
spreads over slices, a voice over parts of at most about `GROUP_ROWS` rows; statistics, sample and so forest and
threshold are those of the whole source in each of its parts.

Defined results: null values, unknown voices and null sources have no cases; values that are not finite are impossible;
repeated rows count once in runs, statistics and neighbours, and each of them is a case; rows without a time are judged by
level (segments) and physical limits only; empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loquela.functions.timeutil import DAY_US, clock_parts
from loquela.functions.voices import UNKNOWN, with_voice
from loquela.session import cut

#: Physical limits (inclusive) of each field.
LIMITS = {"f0_mean_hz": (20.0, 1000.0), "jitter_local": (0.0, 1.0), "shimmer_local": (0.0, 1.0), "heart_rate": (25.0, 230.0)}
FIELDS = ["f0_mean_hz", "jitter_local", "shimmer_local"]
#: The probe of a voice's threshold: robust units off its usual level, its neighbours and its recording; that of a wearer's: beats off both sides.
FAR, FAR_JUMP = 4.6, 22.0
#: Ratio of the quartiles' distances to the median from which the farther quartile lies among wrong values.
LOPSIDED = 5.0
STUCK_SEGMENTS, STUCK_READINGS = 5, 15
#: Minutes between readings that still count as neighbours; a burst lasts so many minutes or readings at most, pulse that stays up longer is behaviour.
NEAR_MIN, BURST_MIN, BURST_READINGS = 40.0, 10.0, 3
#: A step between neighbours that may open a burst: beats, and beats more for each minute beyond the first up to the sixth; a step between calm ones.
STEP, STEP_PER_MIN, STEP_MIN, CALM = 12.0, 3.0, 5.0, 6.0
SLICE_DAYS, CONTEXT = 30, 64
GROUP_ROWS = 50_000
#: The forest: trees, rows each, depth, units within which a row is ordinary, chance of each feature to be cut, reach of cuts beyond the rows.
TREES, PSI, DEPTH, ORDINARY = 48, 64, 7, 4.0
VOICE_FEATURES = ((0.45, 4.0), (0.2, 4.0), (0.3, 4.0), (0.05, 3.0))
PULSE_FEATURES = ((0.2, 3.0), (0.5, 6.0), (0.2, 3.0), (0.1, 3.0))


class IsolationForest:
    """Isolation trees of one depth, grown level by level over all trees at once; `shape` has chance and reach of each feature."""

    def __init__(self, x: np.ndarray, shape: tuple[tuple[float, float], ...], trees: int = TREES, depth: int = DEPTH, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        (n, d), self.depth = x.shape, depth
        chance, reach = np.array(shape).T
        self.nodes = nodes = 2 ** (depth + 1) - 1
        self.feature = np.searchsorted(np.cumsum(chance / chance.sum())[:-1], rng.random((trees, nodes)))
        self.cut, path, count = np.zeros((trees, nodes)), np.zeros((trees, nodes)), np.zeros((trees, nodes))
        place, at, flat = rng.random((trees, nodes)), np.zeros((trees, n), dtype=np.int64), np.ascontiguousarray(x).ravel()
        own = np.arange(trees)[:, None] * nodes
        for level in range(depth + 1):
            first, end = 2**level - 1, 2 ** (level + 1) - 1
            wide = end - first
            node = ((at - first) + np.arange(trees)[:, None] * wide).ravel()
            count[:, first:end] = np.bincount(node, minlength=trees * wide).reshape(trees, wide)
            here = count[:, first:end]
            ends_here = level + np.where(here > 1, _mean_path(here), 0.0)
            if level:
                up = (np.arange(first, end) - 1) // 2  # once alone, the path ends there
                ends_here = np.where(count[:, up] <= 1, path[:, up], ends_here)
            path[:, first:end] = ends_here
            if level == depth:
                break
            value = flat[np.arange(n) * d + self.feature.ravel()[own + at]]
            order = np.lexsort((value.ravel(), node))
            filled = np.flatnonzero(here.ravel())
            last = np.cumsum(here.ravel()[filled]).astype(np.int64)
            low, high = np.zeros(trees * wide), np.zeros(trees * wide)
            low[filled], high[filled] = value.ravel()[order[np.r_[0, last[:-1]]]], value.ravel()[order[last - 1]]
            beyond = reach[self.feature[:, first:end]]
            low, high = low.reshape(trees, wide), high.reshape(trees, wide)
            self.cut[:, first:end] = low - beyond + place[:, first:end] * (high - low + 2 * beyond)
            at = 2 * at + 1 + (value > self.cut.ravel()[own + at])
        self.path, self.usual = path, max(float(_mean_path(np.array([n]))[0]), 1e-9)

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / usual path): the nearer to 1, the more isolated."""
        feature, cut_at, path = (np.ascontiguousarray(a).ravel() for a in (self.feature.astype(np.int64), self.cut, self.path))
        trees, d = len(self.cut), x.shape[1]
        root, out = np.arange(trees)[:, None] * self.nodes, np.empty(len(x))
        for start in range(0, len(x), 1024):
            part = np.ascontiguousarray(x[start : start + 1024])
            flat, rows = part.ravel(), np.arange(len(part)) * d
            at = np.zeros((trees, len(part)), dtype=np.int64)
            for _ in range(self.depth):
                node = root + at
                at = 2 * at + 1 + (flat.take(rows + feature.take(node)) > cut_at.take(node))
            out[start : start + 1024] = path.take(root + at).mean(0)
        return 2.0 ** (-out / self.usual)


def _mean_path(n: np.ndarray) -> np.ndarray:
    big = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(big - 1) + 0.5772156649) - 2 * (big - 1) / big, np.where(n == 2, 1.0, 0.0))


def isolated(x: np.ndarray, sample: np.ndarray, probes: np.ndarray, shape: tuple[tuple[float, float], ...], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Scores of the rows of `x` by a forest of the ordinary rows of `sample`, and which are as isolated as the probes."""
    rng = np.random.default_rng(seed)
    fit = sample[(np.abs(sample[:, :3]) <= ORDINARY).all(1)][:PSI]
    drawn = rng.standard_normal((PSI - len(fit), 1))
    filled = np.column_stack([np.repeat(drawn, 3, axis=1) + 0.4 * rng.standard_normal((len(drawn), 3)), np.zeros(len(drawn))])
    forest = IsolationForest(np.concatenate([fit, filled]), shape, seed=seed)
    score = forest.score(x)
    return score, score >= forest.score(probes).mean()


def run_lengths(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Length of the run of equal successive values each row is in; runs end where `group` changes."""
    if not len(values):
        return np.zeros(0, dtype=np.int64)
    new = np.r_[True, (values[1:] != values[:-1]) | (group[1:] != group[:-1])]
    no = np.cumsum(new) - 1
    return np.bincount(no)[no]


def burst_amplitude(at_min: np.ndarray, value: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """How far each value leaves both its sides (signed; 0 where it lies between them), alone or in a burst.

    Steps and gaps part the series into stretches. A short stretch that leaves both sides in one direction is a burst; the
    narrowest are taken out first (of equal ones the farthest from `usual`), so what lies between two bursts isn't one.
    Beside a gap one calm side has to do, and counts two thirds.
    """
    n, amp = len(value), np.zeros(len(value))
    alive = np.arange(n)
    while len(alive) > 1:
        t, v = at_min[alive], value[alive]
        near = np.diff(t) <= NEAR_MIN
        step = np.diff(v)
        jump = near & (np.abs(step) >= STEP + STEP_PER_MIN * np.clip(np.diff(t) - 1, 0, STEP_MIN))
        start = np.r_[0, np.flatnonzero(jump | ~near) + 1]
        end = np.r_[start[1:], len(v)] - 1
        width = end - start + 1
        left, right = np.r_[False, jump[start[1:] - 1]], np.r_[jump[end[:-1]], False]
        rise, fall = np.r_[0.0, step[start[1:] - 1]], np.r_[-step[end[:-1]], 0.0]
        brief = (width <= BURST_READINGS) | (t[end] - t[start] <= BURST_MIN)
        off = np.abs(np.add.reduceat(v - usual[alive], start) / width)
        k = np.arange(len(start))
        both = left & right & (np.sign(rise) == np.sign(fall))
        beside = np.where(left, np.maximum(k - 1, 0), np.minimum(k + 1, len(k) - 1))
        calm = np.r_[False, False, near & (np.abs(step) <= CALM), False, False]  # calm[i + 2] is the step after i
        steady = np.where(left, calm[start], calm[end + 3])
        one = (left ^ right) & (width < BURST_READINGS) & (width[beside] >= BURST_READINGS) & steady & (off > off[beside])
        able = brief & (both | one)
        ahead = lambda b: ~able[b] | (width < width[b]) | ((width == width[b]) & (off >= off[b]))  # noqa: E731, B023
        chosen = np.flatnonzero(able & (ahead(np.maximum(k - 1, 0)) | ~left) & (ahead(np.minimum(k + 1, len(k) - 1)) | ~right))
        if not len(chosen):
            break
        gone = np.zeros(len(v), bool)
        member = np.repeat(chosen, width[chosen])
        place = np.concatenate([np.arange(start[c], end[c] + 1) for c in chosen]) if len(chosen) < 64 else np.flatnonzero(np.isin(np.repeat(k, width), chosen))
        a, b = v[np.maximum(start[member] - 1, 0)], v[np.minimum(end[member] + 1, len(v) - 1)]
        sign = np.where(left[member], np.sign(rise[member]), np.sign(fall[member]))
        off_a, off_b = sign * (v[place] - a), sign * (v[place] - b)
        size = np.where(both[member], np.minimum(off_a, off_b), np.where(left[member], off_a, off_b) * 2 / 3)
        amp[alive[place]] = sign * np.maximum(size, 0)
        gone[place] = True
        alive = alive[~gone]
    if len(alive) > 2:
        t, v = at_min[alive], value[alive]
        near, step = np.diff(t) <= NEAR_MIN, np.diff(v)
        a, b = step[:-1], -step[1:]
        amp[alive[1:-1]] = np.where(near[:-1] & near[1:] & (np.sign(a) == np.sign(b)), np.sign(a) * np.minimum(np.abs(a), np.abs(b)), 0)
    return amp


# ---- segments ----


def _cut_batches(batches: Iterator[pa.RecordBatch], key: str, rows: int = 100_000) -> Iterator[pa.Table]:
    """Tables that hold whole keys, from batches sorted by key."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held)
        codes = table.column(key).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(codes[1:] != codes[:-1])
        if len(edges):
            end = int(edges[-1]) + 1
            yield table.slice(0, end)
            held, size = table.slice(end).combine_chunks().to_batches(), table.num_rows - end
    if size:
        yield pa.Table.from_batches(held)


def _group_median(value: np.ndarray, group: np.ndarray, least: int) -> np.ndarray:
    """Each row's group median; NaN for groups of fewer than `least`."""
    if not len(value):
        return np.zeros(0)
    order = np.lexsort((value, group))
    g = group[order]
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    size = np.diff(np.r_[start, len(g)])
    middle = (value[order[start + (size - 1) // 2]] + value[order[start + size // 2]]) / 2
    out = np.empty(len(value))
    out[order] = np.repeat(np.where(size >= least, middle, np.nan), size)
    return out


def _local_median(value: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Median of each value with the two before and after it in its group."""
    stack = np.full((5, len(value)), np.nan)
    for i, shift in enumerate((-2, -1, 0, 1, 2)):
        here = np.arange(max(0, -shift), len(value) - max(0, shift))
        same = here[group[here] == group[here + shift]]
        stack[i, same] = value[same + shift]
    stack = np.sort(stack, axis=0)
    n = (~np.isnan(stack)).sum(0)
    cols = np.arange(len(value))
    return (stack[(n - 1) // 2, cols] + stack[n // 2, cols]) / 2


def _session_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per field: the value, its run, and the logarithm's distances from the neighbours and from the recording's median."""
    for table in _cut_batches(batches, "stem"):
        text = lambda c: table.column(c).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)  # noqa: E731, B023
        stem, voice = text("stem"), text("voice")
        start = table.column("start_sec").to_numpy()
        idx = table.column("idx").cast(pa.int64()).fill_null(-1).to_numpy()
        timed = np.isfinite(start)
        group = np.cumsum(np.r_[True, (stem[1:] != stem[:-1]) | (voice[1:] != voice[:-1])])
        alike = np.r_[False, (group[1:] == group[:-1]) & (idx[1:] == idx[:-1]) & ((start[1:] == start[:-1]) | ~(timed[1:] | timed[:-1]))]
        repeat = alike & timed
        owner = np.maximum.accumulate(np.where(repeat, 0, np.arange(len(repeat))))
        copy = alike.copy()
        for name in FIELDS:
            value, present = table.column(name).to_numpy(), table.column(name).is_valid().to_numpy()
            copy[1:] &= (value[1:] == value[:-1]) | ~(present[1:] | present[:-1])
        out = {"voice": table.column("voice"), "segment_id": table.column("segment_id"), "copy": pa.array(copy)}
        for name in FIELDS:
            column, (low, high) = table.column(name), LIMITS[name]
            value = column.to_numpy()
            use = np.flatnonzero(column.is_valid().to_numpy() & timed & ~repeat)
            run = np.ones(len(value), dtype=np.int64)
            run[use] = run_lengths(value[use], group[use])
            fine = use[(value[use] > max(low, 0.0)) & (value[use] <= high)]
            log, diff, season = np.log(value[fine]), np.full(len(value), np.nan), np.full(len(value), np.nan)
            diff[fine], season[fine] = log - _local_median(log, group[fine]), log - _group_median(log, group[fine], 5)
            lone = np.bincount(group[fine], minlength=group[-1] + 1)[group] < 3
            diff[lone] = np.nan
            out |= {name: column, f"run_{name}": pa.array(run[owner].astype(np.int32)), f"diff_{name}": pa.array(diff[owner].astype(np.float32)), f"season_{name}": pa.array(season[owner].astype(np.float32))}
        yield from pa.table(out).combine_chunks().to_batches()


_SESSION_SCHEMA = "voice string, segment_id long, copy boolean, " + ", ".join(f"{f} double, run_{f} int, diff_{f} float, season_{f} float" for f in FIELDS)


def own_scale(below: float, above: float) -> float:
    """Robust scale from the distances of the quartiles to the median; of very unequal ones the larger holds wrong values."""
    return 2 * min(below, above) / 1.349 if max(below, above) > LOPSIDED * min(below, above) else (below + above) / 1.349


def _voice_rows(value, run, diff, season, centre: float, scale: float) -> np.ndarray:
    """The four features; where neighbours or recording say nothing, the level stands in."""
    level = (np.log(value) - centre) / scale
    return np.column_stack([level, *(np.where(np.isnan(d), level, d / scale) for d in (diff, season)), np.log2(run)])


def _judge_voice(pooled: dict[str, tuple[float, float, float]], decide=isolated):
    """Cases of one part of a voice; pooled: the median log level of voices, their spread, and the usual scale."""

    def run(key, rows: pa.Table, source: pa.Table) -> pa.Table:
        ids = rows.column("segment_id").to_numpy() if rows.num_rows else np.zeros(0, np.int64)
        found, fields = [np.zeros(0, np.int64)], []
        for name in FIELDS if rows.num_rows and source.num_rows else []:
            low, high = LIMITS[name]
            have = np.flatnonzero(rows.column(name).is_valid().to_numpy())
            if not len(have):
                continue
            part = lambda p: rows.column(p + name).to_numpy()[have]  # noqa: E731, B023
            value, length = part(""), part("run_")
            q1, q2, q3, n = (source.column(f"{p}_{name}")[0].as_py() for p in ("q1", "q2", "q3", "n"))
            bad = ~np.isfinite(value) | (value < low) | (value > high) | (value <= 0)
            mid, spread, usual = pooled[name]
            if n and n >= 5 and q1 > 0:
                centre, own = np.log(q2), own_scale(np.log(q2 / q1), np.log(q3 / q2))
                scale = max(own, 0.7 * usual) if n >= 20 else max(own, usual)
            else:
                centre, scale = mid, max(spread, usual)
            sample = np.array([[np.nan if v is None else v for v in r[name].values()] for r in source.column("sample")[0].as_py() if r[name]["value"] is not None], float).reshape(-1, 4)
            sample = _voice_rows(*sample[(sample[:, 0] > max(low, 0)) & (sample[:, 0] <= high)].T, centre, scale)
            x = _voice_rows(np.where(bad, np.exp(centre), value), length, part("diff_").astype(float), part("season_").astype(float), centre, scale)
            probes = np.array([[FAR, FAR, FAR, 0.0], [-FAR, -FAR, -FAR, 0.0]])
            _, far = decide(x, sample, probes, VOICE_FEATURES)
            hit = have[bad | far | (length >= STUCK_SEGMENTS)]
            found.append(ids[hit])
            fields += [name] * len(hit)
        return pa.table({"row_id": np.concatenate(found), "field": pa.array(fields, pa.string())})

    return run


def segment_cases(segments: DataFrame, speaker_map: DataFrame, decide=isolated) -> DataFrame:
    """row_id, field of the wrong voice measurements, judged per voice; `decide` gives scores and verdicts."""
    voiced = with_voice(segments, speaker_map, ["segment_id", "idx", "start_sec", *FIELDS]).filter(F.col("voice") != UNKNOWN)
    doubles = voiced.select("stem", "voice", "segment_id", "idx", *(F.col(c).cast("double").alias(c) for c in ["start_sec", *FIELDS]))
    ordered = doubles.repartition("stem").sortWithinPartitions("stem", "voice", "start_sec", "idx", "segment_id")
    features = cut(ordered.mapInArrow(_session_features, _SESSION_SCHEMA))
    aggs = [F.count("*").alias("rows")]
    for name in FIELDS:
        low, high = LIMITS[name]
        fine = F.when(~F.col("copy") & (F.col(name) > max(low, 0.0)) & (F.col(name) <= high), F.col(name))
        q = F.percentile_approx(fine, [0.25, 0.5, 0.75], 1000)
        aggs += [q.alias(f"q_{name}"), F.count(fine).alias(f"n_{name}")]
    stats = features.groupBy("voice").agg(*aggs)
    stats = cut(stats.select("voice", "rows", *(f"n_{f}" for f in FIELDS), *(F.get(f"q_{f}", F.lit(i)).alias(f"q{i + 1}_{f}") for f in FIELDS for i in range(3))))
    spread = [
        F.percentile_approx(e, [0.25, 0.5, 0.75], 1000).alias(f"{k}_{f}")
        for f in FIELDS
        for k, e in (("mid", F.when(F.col(f"n_{f}") >= 5, F.log(f"q2_{f}"))), ("scale", F.when(F.col(f"n_{f}") >= 20, (F.log(f"q3_{f}") - F.log(f"q1_{f}")) / 1.349)))
    ]
    row = stats.agg(*spread).first()
    pooled = {}
    for f in FIELDS:
        mid, scale = row[f"mid_{f}"] or [0.0, 0.0, 0.0], row[f"scale_{f}"] or [0.0, 0.2, 0.0]
        pooled[f] = (mid[1], (mid[2] - mid[0]) / 1.349, max(scale[1], 1e-3))
    first = Window.partitionBy("voice").orderBy(F.xxhash64("segment_id"), "segment_id")
    values = [F.struct(F.col(f).alias("value"), F.col(f"run_{f}").cast("double").alias("run"), F.col(f"diff_{f}").cast("double").alias("diff"), F.col(f"season_{f}").cast("double").alias("season")).alias(f) for f in FIELDS]
    picked = features.filter("not copy").select("voice", "segment_id", F.struct(*values).alias("r")).withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= PSI + PSI // 2)
    samples = picked.groupBy("voice").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "r"))), lambda e: e["r"]).alias("sample"))
    parts = F.ceil(F.col("rows") / GROUP_ROWS).cast("int")
    sources = stats.join(samples, "voice").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).withColumnRenamed("voice", "_voice")
    rows = features.join(stats.select("voice", parts.alias("_parts")), "voice").withColumn("part", F.pmod(F.xxhash64("segment_id"), F.col("_parts")).cast("int")).drop("_parts", "copy")
    judged = rows.repartition("voice", "part").groupBy("voice", "part").cogroup(sources.groupBy("_voice", "_part"))
    return judged.applyInArrow(_judge_voice(pooled, decide), "row_id long, field string")


# ---- readings ----


def _pulse_summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a slice: its first and last readings, and the lengths of its first and last run."""
    for table in _cut_batches(batches, "place"):
        place = table.column("place").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        at, value = table.column("at").to_numpy(), table.column("value").to_numpy()
        run = run_lengths(value, place)
        start = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        end = np.r_[start[1:], len(place)]
        piece = lambda x, side: pa.array([x[a : min(a + CONTEXT, b)] if side else x[max(a, b - CONTEXT) : b] for a, b in zip(start, end)], pa.list_(pa.int64()))  # noqa: E731, B023
        out = {"wearer": table.column("wearer").take(pa.array(start)), "slice": table.column("slice").take(pa.array(start)), "n": pa.array(end - start)}
        out |= {"head_at": piece(at, True), "head": piece(value, True), "tail_at": piece(at, False), "tail": piece(value, False), "first_run": pa.array(run[start]), "last_run": pa.array(run[end - 1])}
        yield from pa.table(out).combine_chunks().to_batches()


_SUMMARY = "wearer long, slice long, n long, head_at array<long>, head array<long>, tail_at array<long>, tail array<long>, first_run long, last_run long"
_BESIDE = "wearer long, slice long, pre_at array<long>, pre array<long>, post_at array<long>, post array<long>, run_in long, run_out long"

_BESIDE_COLUMNS = ["pre_at", "pre", "post_at", "post", "run_in", "run_out"]


def _beside(table: pa.Table) -> pa.Table:
    """For each slice of a wearer (one summary row a slice, so as many as the recorded time has) the readings beside it and the runs that reach it."""
    rows = sorted(table.to_pylist(), key=lambda r: r["slice"])
    out = [{"wearer": r["wearer"], "slice": r["slice"]} for r in rows]
    for order, edge, other, at, inner, name in ((range(len(rows)), "head", "tail", "pre", "last_run", "run_in"), (range(len(rows) - 1, -1, -1), "tail", "head", "post", "first_run", "run_out")):
        times, values, run = [], [], 0
        for i in order:
            r, first = rows[i], 0 if at == "pre" else -1
            here = run if values and values[-1 - first] == r[edge][first] else 0
            out[i] |= {f"{at}_at": times, at: values, name: here}
            run = r[inner] + (here if r[inner] == r["n"] else 0)
            both = (times + r[f"{other}_at"], values + r[other]) if at == "pre" else (r[f"{other}_at"] + times, r[other] + values)
            times, values = (x[-CONTEXT:] if at == "pre" else x[:CONTEXT] for x in both)
    lists = pa.list_(pa.int64())
    schema = pa.schema([("wearer", pa.int64()), ("slice", pa.int64()), ("pre_at", lists), ("pre", lists), ("post_at", lists), ("post", lists), ("run_in", pa.int64()), ("run_out", pa.int64())])
    return pa.Table.from_pylist(out, schema=schema)


_FEATURES = "wearer long, slice long, at long, value long, amp double, run int"


def _pulse_features(key, rows: pa.Table, beside: pa.Table) -> pa.Table:
    """Amplitude and run of every distinct reading of a slice."""
    if not rows.num_rows:
        return pa.table({n: pa.array([], t) for n, t in zip(("wearer", "slice", "at", "value", "amp", "run"), (pa.int64(),) * 4 + (pa.float64(), pa.int32()))})
    rows = rows.sort_by([("at", "ascending"), ("value", "ascending")])
    near = {c: np.array(beside.column(c)[0].as_py(), dtype=np.int64) for c in ("pre_at", "pre", "post_at", "post")}
    t, v = rows.column("at").to_numpy(), rows.column("value").to_numpy()
    run = run_lengths(v, np.zeros(len(v)))
    whole = run[0] == len(v)
    run_in, run_out = (beside.column(c)[0].as_py() for c in ("run_in", "run_out"))
    first, last = v == v[0], v == v[-1]
    lead, trail = np.cumprod(first).astype(bool), np.cumprod(last[::-1])[::-1].astype(bool)
    run = run + np.where(lead, run_in, 0) + np.where(trail, run_out, 0) if not whole else run + run_in + run_out
    every_t, every_v = np.r_[near["pre_at"], t, near["post_at"]], np.r_[near["pre"], v, near["post"]].astype(float)
    low, high = LIMITS["heart_rate"]
    fine = np.flatnonzero((every_v >= low) & (every_v <= high))
    amp = np.zeros(len(every_v))
    amp[fine] = burst_amplitude(every_t[fine] / 60e6, every_v[fine], np.full(len(fine), np.median(every_v[fine]) if len(fine) else 0.0))
    amp = amp[len(near["pre"]) : len(near["pre"]) + len(v)]
    return pa.table({"wearer": rows.column("wearer"), "slice": rows.column("slice"), "at": t, "value": v, "amp": amp, "run": pa.array(run.astype(np.int32))})


def _pulse_rows(value, amp, run, hour, source: dict) -> np.ndarray:
    """The four features of readings: level and season against the wearer's usual range, above and below apart."""
    mid, up, down = source["mid"], 1.2 * (source["top"] - source["mid"]) + 5, 1.2 * (source["mid"] - source["bottom"]) + 5
    usual = np.array([source["hours"].get(h, mid) for h in range(24)])[hour.astype(np.int64)]
    level, season = value - mid, value - usual
    scaled = [np.where(x > 0, x / up, x / down) for x in (level, season)]
    return np.column_stack([scaled[0], amp / source["unit"], scaled[1], np.log2(run)])


def _judge_wearer(key, rows: pa.Table, source: pa.Table, decide=isolated) -> pa.Table:
    """Wrong readings of one slice of a wearer."""
    names = ("wearer", "at", "value")
    if not rows.num_rows or not source.num_rows:
        return pa.table({n: pa.array([], pa.int64()) for n in names})
    low, high = LIMITS["heart_rate"]
    one = source.slice(0, 1).to_pylist()[0]
    one["hours"] = {h["hour"]: h["usual"] for h in one["hours"]}
    one["unit"] = max(2 * one["stir"], 4.0)
    columns = lambda at, value, amp, run: _pulse_rows(value.astype(float), amp, run.astype(float), at // 3_600_000_000 % 24, one)
    value, length = rows.column("value").to_numpy(), rows.column("run").to_numpy()
    bad = (value < low) | (value > high)
    sample = np.array([[r["at"], r["value"], r["amp"], r["run"]] for r in one["sample"] or []], float).reshape(-1, 4)
    jump = FAR_JUMP / one["unit"]
    _, far = decide(columns(rows.column("at").to_numpy(), np.where(bad, one["mid"], value), rows.column("amp").to_numpy(), length), columns(*sample.T), np.array([[0.0, jump, 0.0, 0.0], [0.0, -jump, 0.0, 0.0]]), PULSE_FEATURES)
    hit = pa.array(np.flatnonzero(bad | far | (length >= STUCK_READINGS)))
    return pa.table({n: rows.column(n).take(hit) for n in names})


def reading_cases(readings: DataFrame, decide=isolated) -> DataFrame:
    """row_id, field of the wrong pulse readings, judged per wearer; `decide` gives scores and verdicts."""
    wall = clock_parts(F.col("hr_date"), F.col("hr_time"))
    rows = readings.filter("heart_rate is not null and wearer_id is not null").select(
        F.col("wearer_id").cast("long").alias("wearer"), wall.alias("at"), F.col("heart_rate").cast("long").alias("value"), F.col("reading_id").cast("long").alias("id")
    )
    timed = rows.filter("at is not null")
    low, high = LIMITS["heart_rate"]
    # Repeated rows are folded before anything looks at neighbours: copies neither fill the edges nor part a run.
    sliced = timed.select("wearer", "at", "value").distinct().withColumn("slice", F.floor(F.col("at") / (SLICE_DAYS * DAY_US)).cast("long"))
    ordered = sliced.withColumn("place", F.concat_ws(" ", "wearer", "slice")).repartition("wearer", "slice").sortWithinPartitions("place", "at", "value")
    ordered = cut(ordered.select("wearer", "slice", "place", "at", "value"))
    beside = ordered.mapInArrow(_pulse_summary, _SUMMARY).groupBy("wearer").applyInArrow(_beside, _BESIDE).toDF("_wearer", "_slice", *_BESIDE_COLUMNS)
    features = cut(ordered.drop("place").groupBy("wearer", "slice").cogroup(beside.groupBy("_wearer", "_slice")).applyInArrow(_pulse_features, _FEATURES))

    fine = features.filter(F.col("value").between(low, high))
    stats = fine.groupBy("wearer").agg(F.percentile_approx(F.col("value").cast("double"), [0.02, 0.5, 0.98], 1000).alias("q"), F.percentile_approx(F.when(F.abs("amp") < STEP, F.abs("amp")), 0.95, 1000).alias("stir"))
    hour = F.pmod(F.floor(F.col("at") / 3_600_000_000), F.lit(24)).cast("int")
    hours = fine.groupBy("wearer", hour.alias("hour")).agg(F.percentile_approx(F.col("value").cast("double"), 0.5, 1000).alias("usual"))
    hours = hours.groupBy("wearer").agg(F.collect_list(F.struct("hour", "usual")).alias("hours"))
    first = Window.partitionBy("wearer").orderBy(F.xxhash64("at", "value"), "at", "value")
    picked = fine.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= PSI + PSI // 2)
    samples = picked.groupBy("wearer").agg(F.array_sort(F.collect_list(F.struct("_n", "at", "value", "amp", "run"))).alias("sample"))
    places = features.select("wearer", "slice").distinct()
    middle = F.get("q", F.lit(1))
    sources = places.join(stats, "wearer", "left").join(hours, "wearer", "left").join(samples, "wearer", "left").select(
        F.col("wearer").alias("_wearer"), F.col("slice").alias("_slice"), F.coalesce(middle, F.lit(75.0)).alias("mid"), F.coalesce(F.get("q", F.lit(0)), F.lit(50.0)).alias("bottom"), F.coalesce(F.get("q", F.lit(2)), F.lit(130.0)).alias("top"),
        F.coalesce("stir", F.lit(2.0)).alias("stir"), F.coalesce("hours", F.expr("cast(array() as array<struct<hour:int,usual:double>>)")).alias("hours"), "sample",
    )
    wrong = features.groupBy("wearer", "slice").cogroup(sources.groupBy("_wearer", "_slice")).applyInArrow(lambda key, rows, source: _judge_wearer(key, rows, source, decide), "wearer long, at long, value long")
    judged = timed.join(wrong, ["wearer", "at", "value"], "left_semi").select(F.col("id").alias("row_id"))
    untimed = rows.filter(F.col("at").isNull() & ((F.col("value") < low) | (F.col("value") > high))).select(F.col("id").alias("row_id"))
    return judged.unionByName(untimed).withColumn("field", F.lit("heart_rate"))


def wrong_values(segments: DataFrame, speaker_map: DataFrame, readings: DataFrame) -> DataFrame:
    """origin, row_id, field of every wrong value."""
    left = segment_cases(segments, speaker_map).select(F.lit("segments").alias("origin"), "row_id", "field")
    return left.unionByName(reading_cases(readings).select(F.lit("helio_battito").alias("origin"), "row_id", "field"))
