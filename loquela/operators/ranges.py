"""Range joins by time buckets: an equi-join on the bucket and the exact bounds as a residual, never a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def buckets(start: Column, end: Column, width: float) -> Column:
    """All buckets that [start, end] touches."""
    return F.sequence(F.floor(start / width).cast("long"), F.floor(F.greatest(start, end) / width).cast("long"))


def points_in_intervals(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str, width: float, closed: bool = True, how: str = "inner") -> DataFrame:
    """Points joined to the intervals of the same keys that hold them ([start, end], or [start, end) if not closed)."""
    p = points.withColumn("_b", F.floor(F.col(at) / width).cast("long"))
    i = intervals.withColumn("_b", F.explode(buckets(F.col(start), F.col(end), width)))
    inside = (F.col(f"p.{at}") >= F.col(f"i.{start}")) & ((F.col(f"p.{at}") <= F.col(f"i.{end}")) if closed else (F.col(f"p.{at}") < F.col(f"i.{end}")))
    on = [F.col(f"p.{k}") == F.col(f"i.{k}") for k in [*keys, "_b"]]
    joined = p.alias("p").join(i.alias("i"), on + [inside], how)
    if how in ("left_semi", "left_anti"):
        return joined.drop("_b")
    extra = [F.col(f"i.{c}").alias(c if c not in points.columns else f"i_{c}") for c in intervals.columns if c not in keys]
    return joined.select(*(F.col(f"p.{c}") for c in points.columns), *extra)


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], start: str, end: str, width: float) -> DataFrame:
    """Pairs of intervals of equal keys that overlap, once each, with the seconds they share."""
    a = left.withColumn("_b", F.explode(buckets(F.col(start), F.col(end), width)))
    b = right.withColumn("_b", F.explode(buckets(F.col(start), F.col(end), width)))
    la, lb = F.col(f"a.{start}"), F.col(f"b.{start}")
    first = F.floor(F.greatest(la, lb) / width) == F.col("a._b")
    shared = F.least(F.col(f"a.{end}"), F.col(f"b.{end}")) - F.greatest(la, lb)
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "_b"]] + [la < F.col(f"b.{end}"), lb < F.col(f"a.{end}"), first]
    cols = [F.col(f"a.{c}") for c in left.columns] + [F.col(f"b.{c}").alias(f"right_{c}") for c in right.columns if c not in keys]
    return a.alias("a").join(b.alias("b"), on).select(*cols, shared.alias("shared"))


def minute_coverage(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Seconds of each minute that the intervals cover (overlaps count twice)."""
    s, e = F.col(start), F.col(end)
    rows = df.filter(e > s).select(*keys, s.alias("_s"), e.alias("_e"), F.explode(buckets(s, e, 60.0)).alias("minute"))
    covered = F.greatest(F.lit(0.0), F.least(F.col("_e"), (F.col("minute") + 1) * 60.0) - F.greatest(F.col("_s"), F.col("minute") * 60.0))
    return rows.groupBy(*keys, "minute").agg(F.sum(covered).alias("covered")).filter("covered > 0")
