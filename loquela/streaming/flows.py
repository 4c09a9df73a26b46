"""Structured Streaming: windows with late data, exactly-once ingestion, and the interval map as keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from loquela.operators.intervals import IntervalMap


def windowed_counts(events: DataFrame, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Tumbling windows per event type; rows later than the watermark are dropped by the engine."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def unique_files(files: DataFrame, late: str = "7 days") -> DataFrame:
    """Each content once, by its hash within the watermark."""
    hashed = files.withColumn("sha", F.sha2("content", 256)).drop("content")
    return hashed.withWatermark("modificationTime", late).dropDuplicatesWithinWatermark(["sha"])


def running_periods(intervals: DataFrame) -> DataFrame:
    """Per entity, after each batch: the number of continuous periods and gaps, covered and missing time.

    `intervals` is a stream of entity, from_us, to_us; the state is the entity's ordered disjoint-interval map.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = IntervalMap(*state.get) if state.exists else IntervalMap()
        for pdf in batches:
            for start, end in zip(pdf["from_us"].tolist(), pdf["to_us"].tolist()):
                held.insert(int(start), int(end))
        state.update((held.starts, held.ends))
        gaps = held.gaps()
        covered = sum(b - a for a, b in held.periods())
        yield pd.DataFrame({"entity": [key[0]], "periods": [len(held.starts)], "gaps": [len(gaps)], "covered_us": [covered], "missing_us": [sum(b - a for a, b in gaps)]})

    usable = intervals.filter("entity is not null and to_us > from_us").select("entity", "from_us", "to_us")
    return usable.groupBy("entity").applyInPandasWithState(
        run, "entity long, periods long, gaps long, covered_us long, missing_us long", "starts array<bigint>, ends array<bigint>", "update", "NoTimeout"
    )
