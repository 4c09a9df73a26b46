"""Queries of the general problems 1, 4 and 5 over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loquela.operators import intervals, spikes, timestamps
from loquela.tables import table


def p1_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every time value with its instant, posterior and status (ambiguity is named, not guessed)."""
    names = ("sessions", "helio_notti", "wearers")
    return timestamps.all_instants(*(table(spark, sf_dir, n) for n in names))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_instants(spark, sf_dir).filter("utc_us is not null").select("origin", "row_id", "utc_us")


def p1_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values of each origin were resolved, and why the others were not."""
    return p1_instants(spark, sf_dir).groupBy("origin", "status").agg(F.count("*").alias("n_values"), F.round(F.min("posterior"), 4).alias("least_posterior"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    instants = timestamps.session_instants(table(spark, sf_dir, "sessions"), table(spark, sf_dir, "wearers"))
    merged = intervals.merge_intervals(intervals.session_intervals(instants))
    return merged.select("kind", F.col("entity").alias("wearer_id"), "from_us", "to_us")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spikes.wrong_values(*(table(spark, sf_dir, n) for n in ("segments", "speaker_map", "helio_battito")))


QUERIES = {f.__name__: f for f in (p1_found, p1_instants, p1_status, p4_found, p5_found)}
SQL: dict[str, str] = {}
