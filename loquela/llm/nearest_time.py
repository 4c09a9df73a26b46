"""Problem 3: matching records by nearest time, through a learned index per entity-time shard.

Both tables are cut into shards of (entity, time slice). Probes (left rows) go to the one shard of their time; readings
(right rows) go to theirs and, within the tolerance of an edge, also to the neighbour, so shard edges overlap and a probe
never needs a second shard. One shuffle brings both together, sorted by shard, and each task streams over its shards.

In a shard the sorted reading times are covered by line pieces from a fixed number of keys each; a piece's largest
residual is its error bound. A probe's position is predicted by its piece's line, and a binary search confined to the
bound gives the exact neighbours on both sides. All shards of a batch are indexed and searched at once by numpy.

Defined results: rows with a null entity or time take no part; equal readings of one instant count as the one with the
smallest id; at equal distance the smallest id wins; repeated probes each get their row; empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys under one line piece, and the width of a time slice.
PIECE = 64
SLICE_US = 6 * 3_600_000_000


class PiecewiseIndex:
    """Piecewise-linear index over a sorted integer array: predicts positions within a known bound."""

    def __init__(self, keys: np.ndarray, piece: int = PIECE) -> None:
        self.keys = keys
        n = len(keys)
        self.first = np.arange(0, n, piece)
        last = np.minimum(self.first + piece, n) - 1
        span = (keys[last] - keys[self.first]).astype(np.float64)
        self.slope = np.where(span > 0, (last - self.first) / np.maximum(span, 1.0), 0.0)
        self.last = last
        own = np.arange(n) // piece
        guess = self.first[own] + (keys - keys[self.first[own]]) * self.slope[own]
        self.error = np.ceil(np.maximum.reduceat(np.abs(guess - np.arange(n)), self.first)).astype(np.int64) + 1

    def lower_bound(self, probes: np.ndarray) -> np.ndarray:
        """For each probe the number of keys below it, exactly."""
        if not len(self.keys):
            return np.zeros(len(probes), dtype=np.int64)
        piece = np.maximum(np.searchsorted(self.keys[self.first], probes, side="left") - 1, 0)
        guess = self.first[piece] + (probes - self.keys[self.first[piece]]) * self.slope[piece]
        guess = np.clip(guess, self.first[piece], self.last[piece] + 1).astype(np.int64)
        lo = np.maximum(guess - self.error[piece], self.first[piece])
        hi = np.minimum(guess + self.error[piece] + 1, self.last[piece] + 1)
        lo = np.where((lo > self.first[piece]) & (self.keys[np.maximum(lo - 1, 0)] >= probes), self.first[piece], lo)
        hi = np.where((hi <= self.last[piece]) & (self.keys[np.minimum(hi, len(self.keys) - 1)] < probes), self.last[piece] + 1, hi)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            below = open_ & (self.keys[np.minimum(mid, len(self.keys) - 1)] < probes)
            lo, hi = np.where(below, mid + 1, lo), np.where(open_ & ~below, mid, hi)
        return lo


def match_sorted(keys: np.ndarray, ids: np.ndarray, probes: np.ndarray, tolerance: int) -> np.ndarray:
    """Index into `keys` of each probe's nearest key within the tolerance, or -1; ties go to the smaller id."""
    if not len(keys) or not len(probes):
        return np.full(len(probes), -1, dtype=np.int64)
    at = PiecewiseIndex(keys).lower_bound(probes)
    right, left = np.minimum(at, len(keys) - 1), np.maximum(at - 1, 0)
    far = np.iinfo(np.int64).max
    d_right = np.where(at < len(keys), np.abs(keys[right] - probes), far)
    d_left = np.where(at > 0, np.abs(probes - keys[left]), far)
    take_left = (d_left < d_right) | ((d_left == d_right) & (ids[left] < ids[right]))
    best = np.where(take_left, left, right)
    return np.where(np.minimum(d_left, d_right) <= tolerance, best, -1)


def _matcher(tolerance_us: int, slice_us: int):
    spread = 4 * (slice_us + 4 * tolerance_us)  # keeps the shards of a batch apart on one axis

    def solve(table: pa.Table) -> pa.RecordBatch:
        entity, slot, kind, at, rid = (table.column(c).to_numpy() for c in ("entity", "slot", "kind", "at", "id"))
        new = np.r_[True, (entity[1:] != entity[:-1]) | (slot[1:] != slot[:-1])] if len(entity) else np.zeros(0, bool)
        axis = (np.cumsum(new) - 1) * spread + (at - slot * slice_us) + 2 * tolerance_us
        reading = kind == 0
        keys, ids = axis[reading], rid[reading]
        if len(keys):  # one reading per instant, the smallest id (ids are sorted within an instant)
            keep = np.r_[True, keys[1:] != keys[:-1]]
            keys, ids = keys[keep], ids[keep]
        best = match_sorted(keys, ids, axis[~reading], tolerance_us)
        hit = best >= 0
        return pa.RecordBatch.from_arrays([pa.array(rid[~reading][hit]), pa.array(ids[best[hit]])], names=["left_id", "right_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < 200_000:
                continue
            table = pa.Table.from_batches(held)
            entity, slot = table.column("entity").to_numpy(), table.column("slot").to_numpy()
            edges = np.flatnonzero((entity[1:] != entity[:-1]) | (slot[1:] != slot[:-1]))
            if not len(edges):
                continue  # one shard so far
            end = int(edges[-1]) + 1
            yield solve(table.slice(0, end))
            held, rows = table.slice(end).combine_chunks().to_batches(), table.num_rows - end
        if rows:
            yield solve(pa.Table.from_batches(held))

    return run


def nearest_in_time(left: DataFrame, right: DataFrame, tolerance_us: int, slice_us: int = SLICE_US) -> DataFrame:
    """`left_id`, `right_id` from rows of `entity`, `at` (microseconds), `id` on both sides (all long)."""
    slot = lambda c: F.floor(c / slice_us).cast("long")
    at = F.col("at")
    usable = F.col("entity").isNotNull() & at.isNotNull() & F.col("id").isNotNull()
    probes = left.filter(usable).select("entity", slot(at).alias("slot"), F.lit(1).alias("kind"), "at", "id")
    unique = right.filter(usable).groupBy("entity", "at").agg(F.min("id").alias("id"))
    slots = F.array_distinct(F.array(slot(at - tolerance_us), slot(at), slot(at + tolerance_us)))
    readings = unique.select("entity", F.explode(slots).alias("slot"), F.lit(0).alias("kind"), "at", "id")
    both = probes.unionByName(readings).repartition("entity", "slot").sortWithinPartitions("entity", "slot", "kind", "at", "id")
    return both.mapInArrow(_matcher(tolerance_us, slice_us), "left_id long, right_id long")
