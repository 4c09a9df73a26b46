"""Gaps and islands: runs, blocks, turns, conversations and moving-window vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], order: list[str | Column], starts: Column, name: str = "island") -> DataFrame:
    """Number the islands of each key; `starts` (may use window functions) is true on an island's first row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_starts", starts).withColumn(name, F.sum(F.when(F.col("_starts"), 1).otherwise(0)).over(w)).drop("_starts")


def blocks_by_gap(df: DataFrame, keys: list[str], start: str, end: str, gap: float, tie: str) -> DataFrame:
    """Blocks of rows no more than `gap` after the end of the row before (inclusive)."""
    w = Window.partitionBy(*keys).orderBy(start, tie)
    before = F.lag(end).over(w)
    return islands(df, keys, [start, tie], before.isNull() | (F.col(start) - before > gap), "block")


def conversations(df: DataFrame, keys: list[str], start: str, end: str, gap: float, tie: str) -> DataFrame:
    """A new conversation begins `gap` or more after the latest end so far."""
    w = Window.partitionBy(*keys).orderBy(start, tie).rowsBetween(Window.unboundedPreceding, -1)
    latest = F.max(end).over(w)
    return islands(df, keys, [start, tie], latest.isNull() | (F.col(start) - latest >= gap), "conversation")


def same_value_runs(df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "run") -> DataFrame:
    """Runs of rows with an equal value."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(value).over(w)
    first = F.row_number().over(w) == 1
    return islands(df, keys, list(order), first | ~F.col(value).eqNullSafe(before), name)


def moving_type_token_ratio(df: DataFrame, keys: list[str], order: list[str], word: str, size: int = 50) -> DataFrame:
    """Mean share of distinct words over all windows of `size` words; null for keys with fewer."""
    w = Window.partitionBy(*keys).orderBy(*order)
    frame = w.rowsBetween(1 - size, 0)
    seen = df.select(*keys, F.row_number().over(w).alias("_n"), F.size(F.collect_set(word).over(frame)).alias("_t"))
    full = F.when(F.col("_n") >= size, F.col("_t") / F.lit(size))
    return seen.groupBy(*keys).agg(F.round(F.avg(full), 4).alias("mattr"), F.count("*").alias("n_words"))
