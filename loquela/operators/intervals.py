"""Problem 4: overlapping and gapped time intervals.

Each (entity, time bucket) is a key with an ordered map of disjoint intervals as its state: an insertion finds the
overlapped ones by binary search, merges them and keeps the gaps between neighbours current (`IntervalMap`). Intervals
go to the bucket of their start, so a key's state is bounded by the bucket's width however hot the entity is. A bucket's
periods may still join those of earlier buckets (an interval that reaches over the edge); this is settled between
buckets from one summary row per bucket, never by bringing an entity's rows into one task. The same map is the state of
the streaming form (`loquela.streaming.intervals`).

Defined results: intervals with a null end, a null entity, or an end not after the start take no part; touching
intervals join; repeated intervals count once; empty input gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loquela.session import cut

#: Width of a time bucket; a parameter of merge_intervals.
BUCKET_US = 30 * 86_400_000_000


class IntervalMap:
    """Ordered disjoint closed-open intervals of one key; `starts` and `ends` are both sorted."""

    def __init__(self, starts: Iterable[int] = (), ends: Iterable[int] = ()) -> None:
        self.starts, self.ends = list(starts), list(ends)

    def insert(self, start: int, end: int) -> None:
        """Insert [start, end): merge with all it overlaps or touches."""
        if end <= start:
            return
        first = bisect_left(self.ends, start)
        last = bisect_right(self.starts, end)
        if first < last:
            start, end = min(start, self.starts[first]), max(end, self.ends[last - 1])
        self.starts[first:last] = [start]
        self.ends[first:last] = [end]

    def periods(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, self.ends))

    def gaps(self) -> list[tuple[int, int]]:
        return list(zip(self.ends, self.starts[1:]))


def _merge_key(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    state = IntervalMap()
    for start, end in zip(pdf["from_us"].tolist(), pdf["to_us"].tolist()):
        state.insert(start, end)
    return pd.DataFrame({"entity": key[0], "bucket": key[1], "from_us": state.starts, "to_us": state.ends})


def merge_intervals(intervals: DataFrame, bucket_us: int = BUCKET_US) -> DataFrame:
    """`kind` ('period' or 'gap'), `entity`, `from_us`, `to_us` from rows of `entity`, `from_us`, `to_us`."""
    clean = (
        intervals.select(F.col("entity").cast("long"), F.col("from_us").cast("long"), F.col("to_us").cast("long"))
        .filter(F.col("entity").isNotNull() & (F.col("to_us") > F.col("from_us")))
        .groupBy("entity", "from_us")
        .agg(F.max("to_us").alias("to_us"))
        .withColumn("bucket", F.floor(F.col("from_us") / bucket_us).cast("long"))
    )
    schema = "entity long, bucket long, from_us long, to_us long"
    local = cut(clean.groupBy("entity", "bucket").applyInPandas(_merge_key, schema))

    # A bucket's periods that begin at or before the latest end of earlier buckets go on with the period there.
    per_bucket = local.groupBy("entity", "bucket").agg(F.max("to_us").alias("most"))
    before = Window.partitionBy("entity").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select("entity", "bucket", F.max("most").over(before).alias("carry"))
    marked = local.join(carry, ["entity", "bucket"]).withColumn("head", F.col("carry").isNull() | (F.col("from_us") > F.col("carry")))

    # Per bucket: the latest end among periods that are no head, and its last head.
    summary = marked.groupBy("entity", "bucket").agg(
        F.max(F.when(~F.col("head"), F.col("to_us"))).alias("reach"),
        F.max(F.when(F.col("head"), F.col("from_us"))).alias("last_head"),
        F.min(F.when(F.col("head"), F.col("from_us"))).alias("first_head"),
    )
    upto = Window.partitionBy("entity").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    chained = summary.withColumn("owner", F.last("last_head", ignorenulls=True).over(upto))
    extension = chained.filter("reach is not null").groupBy("entity", F.col("owner").alias("from_us")).agg(F.max("reach").alias("reach"))
    heads = marked.filter("head").select("entity", "bucket", "from_us", "to_us")
    periods = heads.join(extension, ["entity", "from_us"], "left").select(
        "entity", "bucket", "from_us", F.greatest("to_us", "reach").alias("to_us")
    )

    # The next period begins in the same bucket, or is the first head of the next bucket that has one.
    later = Window.partitionBy("entity").orderBy("bucket").rowsBetween(1, Window.unboundedFollowing)
    nexts = chained.select("entity", "bucket", F.first("first_head", ignorenulls=True).over(later).alias("next_head"))
    inside = Window.partitionBy("entity", "bucket").orderBy("from_us")
    follow = periods.join(nexts, ["entity", "bucket"]).withColumn("then", F.coalesce(F.lead("from_us").over(inside), F.col("next_head")))
    return follow.select(
        "entity",
        F.explode(
            F.array(
                F.struct(F.lit("period").alias("kind"), F.col("from_us").alias("a"), F.col("to_us").alias("b")),
                F.struct(F.lit("gap").alias("kind"), F.col("to_us").alias("a"), F.col("then").alias("b")),
            )
        ).alias("x"),
    ).filter("x.b is not null").select("x.kind", "entity", F.col("x.a").alias("from_us"), F.col("x.b").alias("to_us"))


def session_intervals(instants: DataFrame) -> DataFrame:
    """`entity`, `from_us`, `to_us` of the sessions that have an instant and a positive duration."""
    length = F.round(F.col("duration_sec") * 1_000_000).cast("long")
    usable = F.col("utc_us").isNotNull() & (F.col("duration_sec") > 0) & ~F.isnan("duration_sec")
    return instants.filter(usable).select(F.col("wearer_id").alias("entity"), F.col("utc_us").alias("from_us"), (F.col("utc_us") + length).alias("to_us"))
